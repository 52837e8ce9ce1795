"""Text functions against an independent restatement with Python's ``re``."""

import random
import re

import pytest
from pyspark.sql import functions as F

from paperloom.functions import text as T
from paperloom.functions.charsets import EMOJI_RANGES
from paperloom.functions.contractions import CONTRACTIONS

ALPHABET = [
    *"aemgJCFLkPx",
    *" .!?@;:|•«'\"()/\\,%-",
    *"é°²½日😀©ΣİⓂ㊗🇩_’",
    *"\n\r\t\xa0\x1c\x85\u2028\u200b\u2003",
    *["5", "33", "3.14", "5.", "30 °C", "100°F", "x°C", " don't ", " it's", "(we'll)", "I'm ", "o'clock"],
    *[" km/s ", "m2/g", "cm3/g", "mg/L", " kPa", "bar", "cal ", "L/min", "mL/s", "mm", " m ", " g ", "kg"],
    *["© 2023 x 2021. ", " @user_x"],
]


def strings(seed, count):
    rng = random.Random(seed)
    return ["".join(rng.choice(ALPHABET) for _ in range(rng.randint(0, 30))) for _ in range(count)]


# The rewrites of each step, in Python's syntax.
REWRITES = {
    "usernames": [(r"@\w+", " ")],
    "isolate": [(r"(['\".()!?\\/,])", r" \1 "), (r"[^\w\s?%/.\-]", " "), (r"©.*?\d{4}\.", " ")],
    "copyright": [(r"©.*?\d{4}\.", " ")],
    "emojis": [("[" + "".join(f"{chr(lo)}-{chr(hi)}" for lo, hi in EMOJI_RANGES) + "]+", "")],
    "repeats": [(r"([!?.]){2,}", r"\1")],
    "numbers": [(r"\b\d+\.?\d*\b", " ")],
    "special": [(r"[;:|•«\n]", " ")],
    "spaces": [(r"\s+", " "), (r"^ | $", "")],
}
COMPOUND_FIRST = ["m2/g", "cm3/g"]


def rewrite(name):
    rules = [(re.compile(pattern), new) for pattern, new in REWRITES[name]]

    def apply(s):
        for pattern, new in rules:
            s = pattern.sub(new, s)
        return s

    return apply


def py_units(s):
    degrees = [(rf"(\d+)\s*°\s*{scale}\b", rf"\1 {words}") for scale, words in T.DEGREES.items()]
    bare = [(rf"\b°{scale}\b", f" {words} ") for scale, words in T.DEGREES.items()]
    units = {unit: (rf"\b{unit}\b", f" {words} ") for unit, words in T.UNITS.items()}
    compound = [units.pop(unit) for unit in COMPOUND_FIRST]
    for pattern, new in [*degrees, *compound, *bare, *units.values()]:
        s = re.sub(pattern, new, s)
    return s


def py_contractions(s):
    def long_form(match):
        word = match.group(0)
        return CONTRACTIONS.get(word.replace("’", "'"), word)

    return " ".join(
        re.sub(r"(?<!\w)(?<!\w['’])[a-z]+(?:['’][a-z]+)+(?!\w)(?!['’]\w)", long_form, token) for token in s.split()
    )


def py_clean(s, drop_numbers=False):
    order = ["usernames", "isolate", "emojis", "repeats", *(["numbers"] if drop_numbers else []), "special", "spaces"]
    s = py_contractions(py_units(s).lower())
    for name in order:
        s = rewrite(name)(s)
    return s


STEPS = {
    "units": (T.expand_units, py_units),
    "lower": (T.lower_case, str.lower),
    "contractions": (T.expand_contractions, py_contractions),
    "usernames": (T.remove_usernames, rewrite("usernames")),
    "isolate": (T.isolate_punctuation, rewrite("isolate")),
    "copyright": (T.strip_copyright, rewrite("copyright")),
    "emojis": (T.remove_emojis, rewrite("emojis")),
    "repeats": (T.collapse_repeats, rewrite("repeats")),
    "numbers": (T.remove_numbers, rewrite("numbers")),
    "special": (T.remove_special, rewrite("special")),
    "spaces": (T.collapse_whitespace, rewrite("spaces")),
    "clean": (T.clean_text, py_clean),
    "clean_steps": (T.clean_text_by_steps, py_clean),
    "clean_no_numbers": (lambda c: T.clean_text(c, True), lambda s: py_clean(s, True)),
    "clean_steps_no_numbers": (lambda c: T.clean_text_by_steps(c, True), lambda s: py_clean(s, True)),
}


@pytest.fixture(scope="module")
def results(spark):
    values = strings(7, 4000) + ["", "A", "I'm Σ ΑΣ"]
    frame = spark.createDataFrame([(v,) for v in values], "s string").repartition(8)
    columns = [fn(F.col("s")).alias(name) for name, (fn, _) in STEPS.items()]
    return frame.select("s", *columns).collect()


@pytest.mark.parametrize("name", list(STEPS))
def test_step_equals_python(results, name):
    expected = STEPS[name][1]
    wrong = [(r["s"], r[name], expected(r["s"])) for r in results if r[name] != expected(r["s"])]
    assert not wrong, (len(wrong), wrong[:3])


GOLDENS = {
    "30 °C and 100°F, x°C": "30 degrees celsius and 100 degrees fahrenheit x degrees celsius",
    "I'm at 5 km/s & 3 mg/L 10 kPa": "i meters at 5 kilometers per second 3 milligrams per liter 10 kilopascals",
    "m m m g mm": "meters meters meters grams millimeters",
    "même ém gà m² 5m² H₂O": "même ém gà m² 5m² h₂o",
    "a@b.com @user_x hi": "a . com hi",
    "wait... what?! no!!": "wait . . . what ? no",
    "© 2023 Elsewhere Ltd. All": "2023 elsewhere ltd . all",
    "½ cal; 3:4|5•6«7": "½ calories 3 4 5 6 7",
    "back\\slash / path -dash %": "back slash / path -dash %",
    "日本語 emoji 😀": "emoji",
    "we don't, (it's) fine": "we do not it is fine",
}


def test_goldens_and_null(spark):
    frame = spark.createDataFrame([(k,) for k in GOLDENS] + [(None,)], "s string")
    got = {r.s: r.c for r in frame.select("s", T.clean_text(F.col("s")).alias("c")).collect()}
    assert got.pop(None) is None
    assert got == GOLDENS


def test_cleaning_settles(results):
    for row in results:
        assert "  " not in row["clean"]
        for name in ("repeats", "emojis", "spaces"):
            assert rewrite(name)(row[name]) == row[name]


def test_whole_documents(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("text")
    for row in docs.select("text", T.clean_text(F.col("text")).alias("c")).collect():
        assert row["c"] == py_clean(row["text"])


def test_cleaning_is_one_projection(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    plan = docs.select("doc_id", T.clean_text(F.col("text")).alias("c"))._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan
