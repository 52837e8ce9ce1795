"""URL filters: a rule list, and association rules for the rest.

Each URL becomes a set of tokens (labels of the host, words of the path, keys of the query).
Tokens that stand in the same labelled URLs, all of them, are one item: any of them says what all
say, and the rules of their subsets would double with every token. Spark's FP-growth mines the
item sets of labelled URLs together with their label; rules that name a label and have enough support
and confidence stay. They are indexed by their rarest item, so a URL meets only rules of which
it has that item, and is checked for the others. A URL has an item if it has one of its tokens.

Defined cases: a null URL or one without ``://`` has an empty host and path, fits no rule and
is allowed unless mined rules say otherwise; identical rows are judged alike; null labels are
not mined; fewer than ``MIN_ROWS`` labelled URLs have no rules; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

from pyspark.ml.fpm import FPGrowth
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import numbered
from paperloom.session import stage_table

ALLOW, BLOCK = "allow", "block"
MIN_ROWS = 50
MIN_CONFIDENCE = 0.95
LABEL = "label="

Rule = tuple[str, str]


def host_of(url: Column) -> Column:
    host = F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1)
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(host, upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def url_tokens(url: Column) -> Column:
    """Labels of the host, words of the path and keys of the query; plain numbers are left out."""
    path, query = path_of(url), F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*\?([^#]*)", 1)
    host = F.transform(F.split(host_of(url), r"\."), lambda t: F.when(t != "", F.concat(F.lit("h:"), t)))
    words = F.transform(
        F.split(path, r"[/.]"), lambda t: F.when((t != "") & ~t.rlike("^[0-9]+$"), F.concat(F.lit("p:"), t))
    )
    keys = F.transform(
        F.split(query, "&"), lambda t: F.when(t != "", F.concat(F.lit("q:"), F.substring_index(t, "=", 1)))
    )
    return F.array_sort(F.array_distinct(F.array_compact(F.concat(host, words, keys))))


def listed_rule(host: Column, path: Column, rules: list[Rule]) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, null if none does. ``rules`` is a short
    list of (verdict, host and path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for said, text in sorted(rules, key=lambda r: len(r[1])):
        name, start = text[: text.index("/")], text[text.index("/") :]
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(start)
        rule = F.when(fits, F.lit(text)).otherwise(rule)
        verdict = F.when(fits, F.lit(said)).otherwise(verdict)
    return rule, verdict


def fold(each: DataFrame, least: int) -> DataFrame:
    """(token, item) of the tokens of ``each`` (row_id, token) in ``least`` rows or more; the item is
    the first of the tokens that have the same rows (as many, with the same sums of two hashes)."""
    sums = [F.sum(F.xxhash64("row_id", F.lit(i)).cast("decimal(38,0)")).alias(f"sum{i}") for i in range(2)]
    counts = each.groupBy("token").agg(F.count(F.lit(1)).alias("n"), *sums).filter(F.col("n") >= least)
    same = ["n", "sum0", "sum1"]
    counts = stage_table(counts, "token-rows")
    items = counts.groupBy(*same).agg(F.min("token").alias("item"))
    return stage_table(counts.join(items, same).select("token", "item"), "items")


def mine(labelled: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(rules, items) from (tokens, label), written tables: (rule_items, label, confidence, support)
    and (token, item).

    A rule needs ``MIN_ROWS`` labelled URLs, however many there are; fewer have no rules. Tokens in
    fewer URLs can be in no rule and are left out of the sets.
    """
    known = labelled.filter(F.col("label").isNotNull() & (F.size("tokens") > 0))
    rows = stage_table(known.withColumn("row_id", F.monotonically_increasing_id()), "labelled-urls")
    each = rows.select("row_id", "label", F.explode("tokens").alias("token"))
    items_of = fold(each, MIN_ROWS)
    often = each.join(items_of, "token").groupBy("row_id").agg(F.collect_set("item").alias("often"))
    label = F.array(F.concat(F.lit(LABEL), F.col("label")))
    items = F.concat(F.coalesce("often", F.array().cast("array<string>")), label)
    baskets = stage_table(rows.join(often, "row_id", "left").select(items.alias("items")), "baskets")
    # Half a row less, so that rounding never asks for one more; above 1 nothing has the support.
    support = min(1.0, (MIN_ROWS - 0.5) / max(1, rows.count()))
    if support == 1.0:
        baskets = baskets.limit(0)
    model = FPGrowth(itemsCol="items", minSupport=support, minConfidence=MIN_CONFIDENCE).fit(baskets)
    consequent = F.col("consequent")[0]
    mixed = F.exists("antecedent", lambda t: t.startswith(LABEL))
    rules = model.associationRules.filter(consequent.startswith(LABEL) & ~mixed).select(
        F.array_sort("antecedent").alias("rule_items"),
        F.substring(consequent, len(LABEL) + 1, 1 << 20).alias("label"),
        "confidence",
        "support",
    )
    return stage_table(rules, "mined-rules"), items_of


def match(urls: DataFrame, rules: DataFrame, items_of: DataFrame) -> DataFrame:
    """(row_id, label) of the best rule for each of ``urls`` (row_id, tokens) that has one: the
    highest confidence, then support, then the shorter rule."""
    tokens = urls.select("row_id", F.explode("tokens").alias("token"))
    having = tokens.join(items_of, "token").groupBy("row_id").agg(F.collect_set("item").alias("items"))
    having = stage_table(having, "url-items")
    each = having.select("row_id", "items", F.explode("items").alias("item"))
    counts = each.groupBy("item").agg(F.count(F.lit(1)).alias("n"))
    numbered_rules = rules.withColumn("rule_id", F.xxhash64("rule_items", "label"))
    wanted = numbered_rules.select("rule_id", F.explode("rule_items").alias("item"))
    rarest = (
        wanted.join(counts, "item")
        .groupBy("rule_id")
        .agg(F.min(F.struct("n", "item"))["item"].alias("item"))
    )
    index = stage_table(numbered_rules.join(rarest, "rule_id"), "rule-index")
    met = each.join(index, "item")
    fits = met.filter(F.size(F.array_except("rule_items", "items")) == 0)
    best = F.max(F.struct("confidence", "support", -F.size("rule_items"), F.col("label").alias("label")))
    return fits.groupBy("row_id").agg(best["label"].alias("mined"))


def judge(pages: DataFrame, rules: list[Rule], labels: DataFrame) -> DataFrame:
    """page_id, host, path, rule, verdict of every row, and ``mined``, what the mined rules say
    where the list says nothing. ``labels`` (url, label) is what they are mined from."""
    url = F.col("url")
    parts = pages.select("page_id", host_of(url).alias("host"), path_of(url).alias("path"), url_tokens(url).alias("tokens"))
    rule, verdict = listed_rule(F.col("host"), F.col("path"), rules)
    rows = numbered(parts.select("*", rule.alias("rule"), verdict.alias("listed")), "urls")
    labelled = labels.select(url_tokens(url).alias("tokens"), "label")
    open_ = rows.filter(F.col("listed").isNull()).select("row_id", "tokens")
    mined = match(open_, *mine(labelled))
    judged = rows.join(mined, "row_id", "left")
    return judged.select(
        "page_id", "host", "path", "rule", F.coalesce("listed", "mined", F.lit(ALLOW)).alias("verdict"), "mined"
    )
