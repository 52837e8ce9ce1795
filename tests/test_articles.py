"""Extraction, list literals, dates and stems on small fixtures."""

import datetime
import json
import random

import plain_stem
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from paperloom.functions import articles as A, dates as D, stem as S
from paperloom.operators.flatten import flatten, four_fields, rejects, with_display_names


def article(
    keywords=({"$": "Heat m"}, {"$": "Don't"}),
    authors=({"ce:given-name": "Ann", "ce:surname": "O'Neil"}, {"ce:surname": "Solo"}),
    stamp="2023-01-01T23:30:00-05:00",
    source=None,
    ids=({"@idtype": "PUI", "$": "1"}, {"@idtype": "SCP", "$": "85000000007"}),
    **head,
):
    head = {"abstracts": "An abstract", "citation-title": "A title", "source": source or {}, **head}
    return {
        "abstracts-retrieval-response": {
            "authkeywords": None if keywords is None else {"author-keyword": keywords},
            "coredata": {"dc:creator": {"author": authors}},
            "item": {
                "ait:process-info": {"ait:date-delivered": {"@timestamp": stamp}},
                "bibrecord": {"head": head, "item-info": {"itemidlist": {"itemid": ids}}},
            },
        }
    }


CASES = {
    1: article(),
    2: article(keywords={"$": "Lone Object"}, source={"@country": "fra"}),
    3: article(keywords=None),
    4: article(authors={"ce:given-name": "Eve", "ce:surname": "Alone"}, ids=[{"@idtype": "PUI", "$": "1"}]),
    5: article(abstracts=None),
    6: article(keywords=[]),
    7: article(stamp="not a date"),
}


@pytest.fixture(scope="module")
def raw(spark):
    rows = [(f"https://api.example.org/content/{85_000_000_000 + n}", json.dumps(a)) for n, a in CASES.items()]
    rows.append(("https://api.example.org/content/85000000008", "{broken"))
    return spark.createDataFrame(rows, "url string, raw string")


@pytest.fixture(scope="module")
def flat(raw):
    return {r.article_id - 85_000_000_000: r for r in flatten(raw).collect()}


def test_only_articles_with_keywords(flat):
    assert sorted(flat) == [1, 2, 4, 5, 6, 7]


def test_fields(flat):
    row = flat[1]
    assert row.title == "A title" and row.abstract == "An abstract"
    assert row.keywords == ["heat meters", "do not"]
    assert row.author_names == ["Ann O'Neil"]
    assert row.country == ""
    assert row.publish_date == datetime.date(2023, 1, 1)


def test_lone_nodes_are_lists_of_one(flat):
    assert flat[2].keywords == ["lone object"]
    assert flat[2].country == "fra"
    assert flat[4].author_names == ["Eve Alone"]
    assert flat[6].keywords == []


def test_source_ids(raw):
    ids = sorted(r.article_id for r in flatten(raw, url_col=None).collect())
    assert ids == [0] + [85_000_000_007] * 5


def test_rejects_name_the_missing_path(raw):
    found = {int(r.url[-1]): r.missing for r in rejects(raw, "url").collect()}
    assert found == {5: "abstract", 7: "publish_date", 8: "root"}


def test_record_shapes(raw):
    assert with_display_names(flatten(raw)).columns == list(A.DISPLAY_NAMES.values())
    assert four_fields(flatten(raw)).columns == ["Title", "Abstract", "Publish Date", "Keywords"]


def test_article_json_is_parsed_once(raw):
    plan = flatten(raw)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json(StructField(abstracts-retrieval-response") == 1


def test_bad_url_fails_the_job(spark):
    with pytest.raises(Exception, match="CAST_INVALID_INPUT"):
        spark.createDataFrame([("https://x/y",)], "u string").select(A.id_from_url(F.col("u"))).collect()


LISTS = {
    "['a b', 'c']": ["a b", "c"],
    "[\"Sean O'Brien\", 'X Y']": ["Sean O'Brien", "X Y"],
    "[]": [],
    "['José Ö']": ["José Ö"],
    "": None,
    "plain text": None,
}


def values_of(spark, texts, fn):
    frame = spark.createDataFrame([(t,) for t in texts], "s string")
    return {r.s: r.v for r in frame.select("s", fn(F.col("s")).alias("v")).collect()}


def test_list_literals(spark):
    assert values_of(spark, LISTS, A.parse_list_literal) == LISTS


def test_list_literals_written_by_python(spark):
    lists = [["a\xa0b"], ["it's \"so\""], ["back\\slash", "\\x41"], ["tab\tline\nend"], ["日本", "é"], ["\\'"]]
    expected = {str(items): items for items in lists}
    assert values_of(spark, expected, A.parse_list_literal) == expected


DATES = {
    "5 March 2021": "2021-03-05",
    "05 March 2021": "2021-03-05",
    "March 5, 2021": "2021-03-05",
    "march 5, 2021": "2021-03-05",
    "5  March \t2021": "2021-03-05",
    "Mar 5, 2021": None,
    "31 February 2021": None,
    "2021-03-05": None,
    "5 March 21": None,
    " 5 March 2021": None,
    "March 5 2021": None,
    None: None,
}


def test_long_dates(spark):
    assert values_of(spark, DATES, D.to_iso_date) == DATES
    checks = values_of(spark, DATES, D.is_long_date)
    assert checks == {text: day is not None for text, day in DATES.items()}


def test_epoch_and_rating(spark):
    row = spark.createDataFrame([(1_700_000_000, "4.5")], "t long, r string").select(
        D.epoch_to_timestamp(F.col("t")).cast("string").alias("t"), D.to_double(F.col("r")).alias("r")
    ).first()
    assert (row.t, row.r) == ("2023-11-14 22:13:20", 4.5)


def test_sequence_names_keep_all_digits(spark):
    frame = spark.createDataFrame([(2021, 7), (2021, 12345)], "y int, n int")
    names = [r[0] for r in frame.select(A.sequence_name(F.col("y"), F.col("n"))).collect()]
    assert names == ["20210007", "202112345"]


STEMS = {
    "caresses": "caress", "ponies": "poni", "ties": "tie", "cats": "cat", "feed": "feed", "agreed": "agre",
    "plastered": "plaster", "bled": "bled", "motoring": "motor", "sing": "sing", "conflated": "conflat",
    "troubled": "troubl", "sized": "size", "hopping": "hop", "tanned": "tan", "falling": "fall", "hissing": "hiss",
    "fizzed": "fizz", "failing": "fail", "filing": "file", "happy": "happi", "sky": "sky", "relational": "relat",
    "conditional": "condit", "rational": "ration", "digitizer": "digit", "operator": "oper", "feudalism": "feudal",
    "decisiveness": "decis", "hopefulness": "hope", "formaliti": "formal", "triplicate": "triplic",
    "formative": "form", "electrical": "electr", "goodness": "good", "revival": "reviv", "allowance": "allow",
    "inference": "infer", "airliner": "airlin", "adjustable": "adjust", "replacement": "replac", "adoption": "adopt",
    "effective": "effect", "probate": "probat", "rate": "rate", "cease": "ceas", "controll": "control", "roll": "roll",
    "dying": "die", "news": "news", "died": "die", "spied": "spi", "enjoy": "enjoy", "by": "by", "is": "is",
    "theology": "theolog", "running": "run", "engineering": "engin", "geologies": "geolog",
}


def test_stems(spark):
    assert {word: plain_stem.stem(word) for word in STEMS} == STEMS
    got = values_of(spark, STEMS, S.stem_words)
    assert got == {word: stem + " " for word, stem in STEMS.items()}


def test_stems_of_made_up_words(spark):
    rng = random.Random(3)
    heads = ["", "y", "gy", "tr", "sy", "ay", "oy", "eed", "fly", "é", "ll", "log", "qu", "w", "x", "hopp", "fizz", "iz", "at"]
    tails = [e for e, _ in S.PLURALS + S.LONG_ENDINGS + S.MIDDLE_ENDINGS] + S.LAST_ENDINGS
    tails += ["ed", "ing", "ied", "y", "e", "ll", "eed", "alli", "ationalli", "5", ""]
    words = {
        rng.choice(heads) + "".join(rng.choice("aeiouytslnrwxbé") for _ in range(rng.randint(0, 4))) + rng.choice(tails)
        for _ in range(6000)
    }
    words = {w for w in words if w and "yyy" not in w}
    got = values_of(spark, words, S.stem_words)
    wrong = [(w, got[w], plain_stem.stem(w)) for w in words if got[w] != plain_stem.stem(w) + " "]
    assert not wrong, (len(wrong), wrong[:5])


def test_stem_words(spark):
    got = values_of(spark, ["cats running . 5", "", "Happy  dogs ", None], S.stem_words)
    assert got == {"cats running . 5": "cat run . 5 ", "": "", "Happy  dogs ": "happi dog ", None: None}


def test_each_different_word_of_a_batch_is_stemmed_once(monkeypatch):
    seen = []
    monkeypatch.setattr(S, "stem", lambda word: seen.append(word) or plain_stem.stem(word))
    words = [["left", "out"], ["running", "cats"] * 500, None, [], ["cats", "skies"]]
    got = S._joined_stems(pa.array(words, pa.list_(pa.string())).slice(1)).to_pylist()
    assert got == ["run cat " * 500, None, "", "cat sky "]
    assert sorted(seen) == ["cats", "running", "skies"]
    assert S._joined_stems(pa.array([], pa.list_(pa.string()))).to_pylist() == []


def test_stems_of_texts_do_not_depend_on_batches(spark):
    texts = ["", " ", "\u2003Yes\x1fYES\u00a0\tyes\n", None, "by YING é\U0001f600s ", "cats " * 3000, *["ponies 5 sky"] * 40]
    rows = spark.createDataFrame([(i, text) for i, text in enumerate(texts)], "i int, text string").coalesce(1)
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(name)
    spark.conf.set(name, "3")
    try:
        got = dict(rows.select("i", S.stem_words(F.col("text"))).collect())
    finally:
        spark.conf.set(name, before)
    want = [None if t is None else "".join(plain_stem.stem(w) + " " for w in t.lower().split()) for t in texts]
    assert got == dict(enumerate(want))
