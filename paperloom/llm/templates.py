"""Line dedup by a log-template tree.

A line is a log message: tokens with a digit are variable fields. The tree has a fixed depth:
the number of tokens, then the first ``DEPTH`` tokens. Two passes over its leaves:

1. Lines that are equal but for their fields and spaces form a template, if they have a token that is
   no field; lines of any length are counted.
2. The other lines of ``MIN_TOKENS`` tokens or more (the tree asks for leading tokens) are taken
   leaf by leaf. The lines of a leaf are split into groups of lines that share recurring tokens. In a group,
   a position is constant if one token holds it in most of the group's documents; the rest are
   fields. Constants that make up most of a line form a template, of which a leaf can have any
   number. A line of the leaf belongs to each whose constants it nearly all has.

A template that occurs in ``MIN_DOCS`` documents or more is boilerplate: its lines are dropped
in all of them. Documents are counted, not occurrences, after repeats inside one document are
merged, so a template with any share of the lines is summed in many tasks.

Defined cases: a null text stays null; empty lines and lines of fields alone stay; rows equal in doc_id and text count as one document and are cleaned alike; an
empty table gives an empty result; other columns are kept and may have any name.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import SPACE, whole_text
from paperloom.session import stage_table

DEPTH = 4
MIN_TOKENS = 4
MIN_DOCS = 5
MAJORITY = 0.5
AGREEMENT = 0.8
CONSTANT_SHARE = 0.6

NOT_SPACE = r"[^\x20\x09-\x0D]"
FIELD = rf"(?<!{NOT_SPACE})[^\x20\x09-\x0D0-9]*+[0-9]{NOT_SPACE}*"
FIELD_MARK = "<*>"
DOC = ["doc_id", "text_key"]


def _text_key() -> Column:
    return F.xxhash64("text")


def lines_of(text: Column) -> Column:
    return F.split(text, "\n", -1)


def tokens_of(line: Column) -> Column:
    """Tokens of a line, those with a digit as ``<*>``."""
    masked = F.when(line.rlike("[0-9]"), F.regexp_replace(line, FIELD, FIELD_MARK)).otherwise(line)
    return F.filter(F.split(masked, f"{SPACE}+"), lambda t: t != "")


def _leaf(tokens: Column) -> Column:
    return F.xxhash64(F.size(tokens), F.slice(tokens, 1, DEPTH))


def parse(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, leaf, message) of every line with a token that is no field; numbers
    and hashes only, ``leaf`` is null for a line with too few tokens. Written table."""
    each = docs.select("doc_id", _text_key().alias("text_key"), F.posexplode(lines_of(whole_text())).alias("line", "said"))
    tokens = each.select(*DOC, "line", tokens_of(F.col("said")).alias("tokens"))
    tokens = tokens.filter(F.exists("tokens", lambda t: t != FIELD_MARK))
    leaf = F.when(F.size("tokens") >= MIN_TOKENS, _leaf(F.col("tokens")))
    return stage_table(tokens.select(*DOC, "line", leaf.alias("leaf"), F.xxhash64("tokens").alias("message")), "lines")


def _recurring(lines: DataFrame, *key: str) -> DataFrame:
    """(key, n_docs) of the keys in ``MIN_DOCS`` documents or more."""
    once = lines.select(*key, *DOC).distinct()
    return once.groupBy(*key).agg(F.count(F.lit(1)).alias("n_docs")).filter(F.col("n_docs") >= MIN_DOCS)


def _leaf_lines(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, text_key, line, leaf, tokens) of ``lines``, tokens as hashes."""
    wanted = lines.groupBy(*DOC).agg(F.collect_set(F.struct("line", "leaf")).alias("wanted"))
    wanted = wanted.select(F.col("doc_id").alias("d"), F.col("text_key").alias("k"), "wanted")
    texts = docs.select("doc_id", _text_key().alias("text_key"), lines_of(whole_text()).alias("said"))
    found = texts.join(wanted, F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k")))
    each = found.select(*DOC, "said", F.inline("wanted"))
    tokens = F.transform(tokens_of(F.get("said", F.col("line"))), lambda t: F.xxhash64(t))
    return each.select(*DOC, "line", "leaf", tokens.alias("tokens")).distinct()


def _n_alike(constants: Column) -> Column:
    """How many of ``constants`` (pos, token) the row's tokens have."""
    return F.size(F.filter(constants, lambda c: F.get("tokens", c["pos"]) == c["token"]))


def _summaries(rows: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(group, constants, at) of each group of ``rows`` in ``MIN_DOCS`` documents or more:
    the tokens that most of its documents hold, empty if they make up too little of a line; and
    the position to split the group at, null if all lines agree in what recurs; and (group, token)
    of the tokens that recur there. Written tables."""
    each = rows.groupBy("group", *DOC).agg(F.count(F.lit(1)).alias("n"), F.max(F.size("tokens")).alias("n_tokens"))
    sizes = each.groupBy("group").agg(
        F.count(F.lit(1)).alias("n_docs"), F.sum("n").alias("n_lines"), F.max("n_tokens").alias("n_tokens")
    )
    tokens = rows.select("group", *DOC, F.posexplode("tokens").alias("pos", "token")).filter(F.col("pos") >= DEPTH)
    holders = tokens.groupBy("group", "pos", "token", *DOC).agg(F.count(F.lit(1)).alias("n"))
    held = holders.groupBy("group", "pos", "token").agg(F.count(F.lit(1)).alias("n_holding"), F.sum("n").alias("n_with"))
    known = stage_table(held.filter(F.col("n_holding") >= MIN_DOCS).join(sizes, "group"), "held")
    token = F.struct("pos", "token")
    splits = F.when(F.col("n_with") < F.col("n_lines"), F.struct("n_holding", (-F.col("pos")).alias("back")))
    of = known.groupBy("group").agg(
        F.collect_list(F.when(F.col("n_holding") > F.col("n_docs") * MAJORITY, token)).alias("constants"),
        F.max("n_tokens").alias("n_tokens"),
        (-F.max(splits)["back"]).alias("at"),
    )
    shaped = F.size("constants") + DEPTH >= F.col("n_tokens") * CONSTANT_SHARE
    of = of.withColumn("constants", F.when(shaped, F.col("constants")).otherwise(F.slice("constants", 1, 0)))
    values = known.join(of.select("group", "at"), "group").filter(F.col("pos") == F.col("at"))
    return stage_table(of.select("group", "constants", "at"), "groups"), stage_table(values.select("group", "token"), "splits")


def _find_templates(rows: DataFrame) -> DataFrame | None:
    """(leaf, template, constants) of the templates in the leaves of ``rows``, null if there are none.

    A group of lines starts as a leaf. If the tokens that most of its documents hold make a template
    that ``MIN_DOCS`` documents follow, that is one, and the group goes on without their lines.
    Otherwise it is split by the tokens at one position that recur in it, where one of them is in
    the most documents. Each step makes every group smaller, so this ends by itself.
    """
    found = None
    rows = rows.withColumn("group", F.col("leaf"))
    step = 0
    while True:
        groups, values = _summaries(rows)
        if groups.isEmpty():
            return found
        joined = rows.join(groups, "group")
        alike = (F.size("constants") > 0) & (_n_alike(F.col("constants")) >= F.size("constants") * AGREEMENT)
        judged = stage_table(joined.withColumn("member", alike), "judged-lines")
        shared = _recurring(judged.filter("member"), "group").select("group", F.lit(True).alias("shared"))
        shared = stage_table(shared, "shared-groups")
        leaf = judged.select("group", "leaf").distinct()
        new = groups.join(shared.select("group"), "group").join(leaf, "group")
        new = new.select("leaf", F.xxhash64("group", F.lit(step)).alias("template"), "constants")
        found = new if found is None else found.unionByName(new)
        left = judged.join(shared, "group", "left").withColumn("shared", F.coalesce("shared", F.lit(False)))
        left = left.filter(F.when(F.col("shared"), ~F.col("member")).otherwise(F.col("at").isNotNull()))
        # Values are met one by one, however many names a position has.
        left = left.withColumn("token", F.get("tokens", F.col("at"))).join(
            values.withColumn("recurs", F.lit(True)), ["group", "token"], "left"
        )
        token = F.when(F.col("recurs"), F.col("token"))
        part = F.when(F.col("shared"), F.col("group")).otherwise(F.xxhash64("group", "at", token))
        rows = stage_table(left.select(*DOC, "line", "leaf", "tokens", part.alias("group")), "left-lines")
        step += 1


def _leaf_templates(docs: DataFrame, lines: DataFrame) -> DataFrame:
    """(doc_id, text_key, line) of the lines that belong to a template of their leaf."""
    leaves = _recurring(lines, "leaf").select("leaf")
    rows = stage_table(_leaf_lines(docs, lines.join(leaves, "leaf")), "leaf-lines")
    found = _find_templates(rows)
    if found is None:
        return rows.select(*DOC, "line").limit(0)
    wanted = found.select("leaf", "template", F.size("constants").alias("n_constant"), F.inline("constants"))
    wanted = stage_table(wanted, "constants")
    tokens = rows.select(*DOC, "line", "leaf", F.posexplode("tokens").alias("pos", "token"))
    alike = tokens.join(wanted, ["leaf", "pos", "token"]).groupBy(*DOC, "line", "template")
    counted = alike.agg(F.count(F.lit(1)).alias("n_alike"), F.first("n_constant").alias("n_constant"))
    return counted.filter(F.col("n_alike") >= F.col("n_constant") * AGREEMENT).select(*DOC, "line").distinct()


def boilerplate(docs: DataFrame) -> DataFrame:
    """(doc_id, text_key, dropped): the numbers of the lines that go, per document that has
    some. Written table."""
    lines = parse(docs)
    messages = stage_table(_recurring(lines, "message").select("message"), "messages")
    equal = lines.join(messages, "message").select(*DOC, "line")
    long = lines.filter(F.col("leaf").isNotNull())
    other = stage_table(long.join(messages, "message", "left_anti").select(*DOC, "line", "leaf"), "other-lines")
    both = equal.unionByName(_leaf_templates(docs, other))
    return stage_table(both.groupBy(*DOC).agg(F.collect_set("line").alias("dropped")), "dropped-lines")


def clean(docs: DataFrame) -> DataFrame:
    """``row`` (all columns of ``docs``, the text without its boilerplate), ``n_lines`` and
    ``n_dropped``."""
    dropped = boilerplate(docs).toDF("d", "k", "dropped")
    rows = docs.select("doc_id", _text_key().alias("text_key"), "text", F.struct("*").alias("row"))
    on = F.col("doc_id").eqNullSafe(F.col("d")) & (F.col("text_key") == F.col("k"))
    lines = lines_of(F.col("text"))
    joined = rows.join(dropped, on, "left").withColumn("lines", F.when(F.col("dropped").isNotNull(), lines))
    kept = F.array_except(F.sequence(F.lit(0), F.size("lines") - 1), "dropped")
    left = F.array_join(F.transform(kept, lambda i: F.get("lines", i)), "\n")
    text = F.when(F.col("dropped").isNull(), F.col("text")).otherwise(left)
    count = F.coalesce(F.size(lines), F.lit(0)).cast("long")
    return joined.select(
        F.col("row").withField("text", text).alias("row"),
        F.when(F.col("text").isNull(), 0).otherwise(count).cast("long").alias("n_lines"),
        F.when(F.col("dropped").isNull(), 0).otherwise(F.size("dropped")).cast("long").alias("n_dropped"),
    )


def drop_lines(docs: DataFrame) -> DataFrame:
    """``docs`` with its boilerplate lines gone from the texts, all its columns."""
    return clean(docs).select("row.*")
