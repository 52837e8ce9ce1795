"""Porter stemming of space-separated text as a Column function.

The published algorithm in its common extended form: short words and a few
irregular ones are left alone, "-ied" and "-ies" treat short words specially, "y"
turns to "i" only after a consonant, and "-alli", "-fulli" and "-logi" are handled.

Spark splits the texts; an Arrow UDF stems each different word of a batch once and puts
the stems in the place of the words, so stemming is part of the projection, without a
shuffle. The same steps as ``F.transform`` over every word cost three times what cleaning
the texts does. Spelling the vocabulary out as rows would shuffle each word of the corpus
twice, with the most frequent word as the hottest key.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from functools import lru_cache

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, SparkSession, functions as F

from paperloom.functions.charsets import SPACE
from paperloom.session import ship_package

# Irregular words, and per step the endings with what replaces them.
# Within a step only the first ending that fits is considered.
IRREGULAR = {
    "sky": "sky",
    "skies": "sky",
    "dying": "die",
    "lying": "lie",
    "tying": "tie",
    "news": "news",
    "innings": "inning",
    "inning": "inning",
    "outings": "outing",
    "outing": "outing",
    "cannings": "canning",
    "canning": "canning",
    "howe": "howe",
    "proceed": "proceed",
    "exceed": "exceed",
    "succeed": "succeed",
}
PLURALS = [("sses", "ss"), ("ies", "i"), ("ss", "ss"), ("s", "")]
AFTER_PARTICIPLE = [("at", "ate"), ("bl", "ble"), ("iz", "ize")]
LONG_ENDINGS = [
    ("ational", "ate"),
    ("tional", "tion"),
    ("enci", "ence"),
    ("anci", "ance"),
    ("izer", "ize"),
    ("bli", "ble"),
    ("alli", "al"),
    ("entli", "ent"),
    ("eli", "e"),
    ("ousli", "ous"),
    ("ization", "ize"),
    ("ation", "ate"),
    ("ator", "ate"),
    ("alism", "al"),
    ("iveness", "ive"),
    ("fulness", "ful"),
    ("ousness", "ous"),
    ("aliti", "al"),
    ("iviti", "ive"),
    ("biliti", "ble"),
    ("fulli", "ful"),
    ("logi", "log"),
]
MIDDLE_ENDINGS = [
    ("icate", "ic"),
    ("ative", ""),
    ("alize", "al"),
    ("iciti", "ic"),
    ("ical", "ic"),
    ("ful", ""),
    ("ness", ""),
]
LAST_ENDINGS = [
    "al",
    "ance",
    "ence",
    "er",
    "ic",
    "able",
    "ible",
    "ant",
    "ement",
    "ment",
    "ent",
    "ion",
    "ou",
    "ism",
    "ate",
    "iti",
    "ous",
    "ive",
    "ize",
]

# The "measure" of a stem is its number of vowel-consonant runs. A "y" is a vowel after a
# consonant; at the start of a word, where it is none, it is written "Y" meanwhile.
_CONSONANTS = "[^aeiou][^aeiouy]*"
_VOWELS = "[aeiouy][aeiou]*"
MEASURE_1_UP = re.compile(f"^(?:{_CONSONANTS})?{_VOWELS}[^aeiou]")
MEASURE_1 = re.compile(f"^(?:{_CONSONANTS})?{_VOWELS}{_CONSONANTS}(?:{_VOWELS})?$")
MEASURE_2_UP = re.compile(f"^(?:{_CONSONANTS})?{_VOWELS}{_CONSONANTS}{_VOWELS}[^aeiou]")
HAS_VOWEL = re.compile(f"^(?:{_CONSONANTS})?[aeiouy]")
ENDS_SHORT = re.compile("^[aeiou][^aeiou]$|(?:[^aeiouy]|[aeiou]y)[aeiou][^aeiouwxyY]$|[^aeiouy]y[^aeiouwxyY]$")
ENDS_DOUBLE = re.compile(r"([^aeiouyY])\1$|[^aeiouy]yy$")
ENDS_CONSONANT = re.compile("[^aeiouy]$|[aeiou]y$")

# Stems of frequent words are kept from batch to batch; this bounds what a worker holds.
STEMS_KEPT = 100_000

Condition = Callable[[str, str], object]


def _by_last_letter(endings: list[tuple[str, str]]) -> dict[str, list[tuple[str, str]]]:
    """Most words are done after one look-up."""
    found: dict[str, list[tuple[str, str]]] = {}
    for ending, new in endings:
        found.setdefault(ending[-1], []).append((ending, new))
    return found


def _replace_first(word: str, endings: dict[str, list[tuple[str, str]]], condition: Condition) -> str:
    """The first ending that fits decides: it is replaced if its condition holds for it and
    what precedes it, else the word stays."""
    for ending, new in endings.get(word[-1:], ()):
        if word.endswith(ending):
            base = word[: -len(ending)]
            return base + new if condition(ending, base) else word
    return word


_PLURALS = _by_last_letter(PLURALS)
_LONG_ENDINGS = _by_last_letter(LONG_ENDINGS)
_MIDDLE_ENDINGS = _by_last_letter(MIDDLE_ENDINGS)
_LAST_ENDINGS = _by_last_letter([(ending, "") for ending in LAST_ENDINGS])


def _plural(word: str) -> str:
    if len(word) == 4 and word.endswith("ies"):
        return word[:-1]
    return _replace_first(word, _PLURALS, lambda ending, base: True)


def _after_participle(base: str) -> str:
    if base.endswith(tuple(ending for ending, _ in AFTER_PARTICIPLE)):
        return base + "e"
    if ENDS_DOUBLE.search(base):
        return base if base[-1] in "lsz" else base[:-1]
    return base + "e" if MEASURE_1.search(base) and ENDS_SHORT.search(base) else base


def _participle(word: str) -> str:
    if word.endswith("ied"):
        return word[:-1] if len(word) == 4 else word[:-2]
    if word.endswith("eed"):
        return word[:-1] if MEASURE_1_UP.search(word[:-3]) else word
    base = word[:-2] if word.endswith("ed") else word[:-3] if word.endswith("ing") else ""
    return _after_participle(base) if HAS_VOWEL.search(base) else word


def _final_y(word: str) -> str:
    fits = word.endswith("y") and len(word) > 2 and ENDS_CONSONANT.search(word[:-1])
    return word[:-1] + "i" if fits else word


def _adverb(word: str) -> str:
    return word[:-2] if word.endswith("alli") and MEASURE_1_UP.search(word[:-4]) else word


def _long_ending(word: str) -> str:
    return _replace_first(
        word, _LONG_ENDINGS, lambda ending, base: MEASURE_1_UP.search(base + "l" if ending == "logi" else base)
    )


def _middle_ending(word: str) -> str:
    return _replace_first(word, _MIDDLE_ENDINGS, lambda ending, base: MEASURE_1_UP.search(base))


def _last_ending(word: str) -> str:
    def condition(ending: str, base: str) -> object:
        return (ending != "ion" or base.endswith(("s", "t"))) and MEASURE_2_UP.search(base)

    return _replace_first(word, _LAST_ENDINGS, condition)


def _final_e(word: str) -> str:
    base = word[:-1]
    drop = word.endswith("e") and (
        MEASURE_2_UP.search(base) or (MEASURE_1_UP.search(base) and not ENDS_SHORT.search(base))
    )
    return base if drop else word


def _double_l(word: str) -> str:
    return word[:-1] if word.endswith("ll") and MEASURE_2_UP.search(word[:-1]) else word


STEPS = [
    _plural,
    _participle,
    _final_y,
    _adverb,
    _long_ending,
    _middle_ending,
    _last_ending,
    _final_e,
    _double_l,
]


@lru_cache(STEMS_KEPT)
def stem(word: str) -> str:
    if len(word) <= 2 or word in IRREGULAR:
        return IRREGULAR.get(word, word)
    stemmed = "Y" + word[1:] if word.startswith("y") else word
    for step in STEPS:
        stemmed = step(stemmed)
    return stemmed.replace("Y", "y")


def _joined_stems(texts: pa.Array) -> pa.Array:
    """The words of each text as one string of their stems."""
    words = pc.list_flatten(texts).dictionary_encode()
    stems = pa.array([stem(word) + " " for word in words.dictionary.to_pylist()], pa.string())
    lengths = pc.fill_null(pc.list_value_length(texts), 0)
    ends = pc.cumulative_sum(lengths)
    starts = pa.concat_arrays([pa.array([0], ends.type), ends])
    lists = pa.ListArray.from_arrays(starts, stems.take(words.indices), mask=pc.is_null(texts))
    return pc.binary_join(lists, "")


def stem_words(text: Column) -> Column:
    """Each word of cleaned text as its stem followed by a space. Words end at white space of
    any kind."""
    ship_package(SparkSession.active())
    words = F.array_remove(F.split(F.lower(text), f"[{SPACE}]+", -1), "")
    return F.arrow_udf(_joined_stems, "string")(words)
