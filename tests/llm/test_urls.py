import itertools
import random

from pyspark.sql import functions as F

from odd_rows import collect
from paperloom.llm import urls
from paperloom.llm.queries import URL_RULES

PAGES = "page_id long, url string, html string, host string, row_id long"


def split(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    end = min([rest.index(c) for c in "/?#" if c in rest], default=len(rest))
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:end])
    path = rest[end:]
    stop = min([path.index(c) for c in "?#" if c in path], default=len(path))
    return host, path[:stop]


def listed(host, path):
    best = (None, None)
    for verdict, text in URL_RULES:
        name, start = text[: text.index("/")], text[text.index("/") :]
        if (host == name or host.endswith("." + name)) and path.startswith(start) and len(text) > len(best[0] or ""):
            best = (text, verdict)
    return best


ODD = [
    None,
    "",
    "no scheme/com/",
    "http://",
    "http://com/",
    "https://X.Example.COM/en/1?x=1#y",
    "https://www.example.com/en/1",
    "https://a.www.example.com/en/",
    "https://notexample.com/en/1",
    "https://example.com",
    "https://example.com?q=/en/",
    "https://a.net/es/1#t",
    "https://a.net/fr",
    "https://net/fr/",
    "ftp://a://b.com/x",
    "http://a.org/" + "long/" * 5000,
    "http://ÄÖ.Com/\n/x",
]


def test_list_matches_brute_force(spark):
    pages = spark.createDataFrame([(i, u, None, "clash", 5) for i, u in enumerate(ODD * 2)], PAGES)
    none = spark.createDataFrame([], "url string, label string")
    rows = collect(urls.judge(pages, URL_RULES, none))
    assert len(rows) == 2 * len(ODD)
    for row in rows:
        host, path = split(ODD[row["page_id"] % len(ODD)])
        rule, verdict = listed(host, path)
        assert (row["host"], row["path"], row["rule"]) == (host, path, rule)
        assert row["verdict"] == (verdict or "allow")


def test_mined_rules_match_brute_force(spark):
    draw = random.Random(2)
    labelled = []
    for i in range(1500):
        site, word = draw.choice(["good", "spam", "news"]), draw.choice(["ads", "text", "win"])
        bad = (site == "spam" and word != "text") or (word == "win" and site == "news" and draw.random() < 0.5)
        labelled.append((f"http://{site}.org/{word}/{i}", "block" if bad else "allow"))
    labels = spark.createDataFrame(labelled + [(None, "block"), ("http://x.org/", None)], "url string, label string")
    mined, _ = urls.mine(labels.select(urls.url_tokens(labels["url"]).alias("tokens"), "label"))
    rules = {(tuple(r["rule_items"]), r["label"]): (r["confidence"], r["support"]) for r in collect(mined)}
    assert (("h:spam", "p:ads"), "block") in rules
    sets = [({f"h:{u.split('/')[2].split('.')[0]}", "h:org", f"p:{u.split('/')[3]}"}, lab) for u, lab in labelled]
    assert rules == every_rule(sets)
    pages = spark.createDataFrame([(i, u, None, None, None) for i, (u, _) in enumerate(labelled)], PAGES)
    found = {r["page_id"]: r["mined"] for r in collect(urls.judge(pages, URL_RULES, labels))}
    for i, (tokens, _) in enumerate(sets):
        fitting = [(c, s, -len(t), lab) for (t, lab), (c, s) in rules.items() if set(t) <= tokens]
        assert found[i] == (max(fitting)[3] if fitting else None)


def every_rule(sets):
    """All sets of tokens that qualify, by counting each."""
    found = {}
    tokens = sorted(set().union(*[s for s, _ in sets]))
    for size in (1, 2, 3):
        for some in itertools.combinations(tokens, size):
            having = [lab for s, lab in sets if set(some) <= s]
            for label in set(having):
                n = having.count(label)
                if n >= urls.MIN_ROWS and n / len(having) >= urls.MIN_CONFIDENCE:
                    found[some, label] = (n / len(having), n / len(sets))
    return found


def mined(spark, labelled):
    labels = spark.createDataFrame(labelled, "url string, label string")
    rules, _ = urls.mine(labels.select(urls.url_tokens(labels["url"]).alias("tokens"), "label"))
    return {(tuple(r["rule_items"]), r["label"]): (r["confidence"], r["support"]) for r in collect(rules)}


def test_tokens_that_stand_together_are_one_item(spark):
    """30 shared tokens would have 2^30 subsets; any one of them blocks, as their rules would."""
    path = "/".join(f"w{j}x" for j in range(30))
    labelled = [(f"http://spam.org/{path}/{i}", "block") for i in range(60)]
    labelled += [(f"http://good.org/a/{i}", "allow") for i in range(60)]
    labels = spark.createDataFrame(labelled, "url string, label string")
    asked = ["http://x.spam.io/", "http://y.io/w7x", "http://y.io/w7", "http://good.io/", "http://good.io/w7x"]
    pages = spark.createDataFrame([(i, u, None, None, None) for i, u in enumerate(asked)], PAGES)
    rows = {r["page_id"]: r for r in collect(urls.judge(pages, URL_RULES, labels))}
    assert [rows[i]["mined"] for i in range(4)] == ["block", "block", None, "allow"]
    assert [rows[i]["verdict"] for i in range(4)] == ["block", "block", "allow", "allow"]
    assert rows[4]["mined"] in ("allow", "block")  # one rule for each, alike in all but the label
    both = {(("h:spam",), "block"), (("h:org", "h:spam"), "block"), (("h:good",), "allow"), (("h:good", "h:org"), "allow")}
    assert mined(spark, labelled).keys() == both


def test_long_urls_count_with_their_frequent_tokens(spark):
    deep = [(f"http://spam.org/{'/'.join(f'w{i}x{j}' for j in range(30))}", "block") for i in range(60)]
    plain = [(f"http://good.org/a{i}", "allow") for i in range(60)]
    rules = mined(spark, deep + plain)
    assert rules[("h:spam",), "block"] == (1.0, 0.5)


def test_the_same_number_of_urls_is_enough_at_every_size(spark):
    url = F.concat(F.when(F.col("id") < 55, "http://spam.org/a").otherwise("http://good.org/a"), F.col("id"))
    rows = spark.range(30_000).select(url.alias("url"), F.when(F.col("id") < 55, "block").otherwise("allow").alias("label"))
    rules = collect(urls.mine(rows.select(urls.url_tokens(F.col("url")).alias("tokens"), "label"))[0])
    assert (["h:spam"], "block") in [(r["rule_items"], r["label"]) for r in rules]


def test_empty_table(spark):
    none = spark.createDataFrame([], "url string, label string")
    assert urls.judge(spark.createDataFrame([], PAGES), URL_RULES, none).count() == 0
