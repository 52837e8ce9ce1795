"""Text cleaning as Column functions.

Each function takes a string column (or an array element inside ``F.transform``)
and returns a string column, so a cleaning step is part of the caller's
projection: no UDF, no shuffle. ``clean_text`` is the whole chain.
"""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.charsets import (
    AFTER_WORD,
    DIGIT,
    EMOJI,
    NOT_AFTER_WORD,
    NOT_BEFORE_WORD,
    SPACE,
    WORD,
    WORD_EDGE,
)
from paperloom.functions.contractions import CONTRACTIONS

# Unit symbols and the words they are written out as.
DEGREES = {"C": "degrees Celsius", "F": "degrees Fahrenheit"}
UNITS = {
    "m2/g": "square meters per gram",
    "cm3/g": "cubic centimeters per gram",
    "km/s": "kilometers per second",
    "mg/L": "milligrams per liter",
    "Pa": "Pascals",
    "kPa": "kilopascals",
    "MPa": "megapascals",
    "bar": "bars",
    "J": "Joules",
    "kJ": "kilojoules",
    "MJ": "megajoules",
    "cal": "calories",
    "kcal": "kilocalories",
    "L/min": "liters per minute",
    "mL/s": "milliliters per second",
    "kg": "kilograms",
    "g": "grams",
    "mg": "milligrams",
    "km": "kilometers",
    "m": "meters",
    "cm": "centimeters",
    "mm": "millimeters",
}

# Longer units come first in the alternation, so "km/s" is never read as "km". The
# look-ahead on the first character rejects most positions at the cost of one
# comparison. A degree sign right after a digit is left to the number rules.
_UNIT = (
    f"(?=[{''.join(sorted({unit[0] for unit in UNITS}))}°])(?:"
    f"{NOT_AFTER_WORD}(?:{'|'.join(sorted(UNITS, key=len, reverse=True))}){NOT_BEFORE_WORD}"
    f"|{AFTER_WORD}(?<!{DIGIT})°[{''.join(DEGREES)}]{NOT_BEFORE_WORD})"
)
_UNIT_WORDS = {**UNITS, **{f"°{scale}": words for scale, words in DEGREES.items()}}
_SPACE_RUN = f"(?![!-~])(?: [{SPACE}]+|[{SPACE}&&[^ ]][{SPACE}]*)"
# A quote around a word is no part of it; one between letters is.
_CONTRACTION = rf"(?<![{WORD}])(?<![{WORD}]['’])[a-z]+(?:['’][a-z]+)+(?![{WORD}])(?!['’][{WORD}])"


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(part) for entry in entries.items() for part in entry])


def _swap_matches(text: Column, pattern: str, swap) -> Column:
    """Replace each match of ``pattern`` by ``swap(match)`` in a single pass: the
    text between the matches is zipped with the rewritten matches."""
    between = F.split(text, pattern, -1)
    matches = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    rewritten = F.concat(F.transform(matches, swap), F.array(F.lit("")))
    return F.array_join(F.zip_with(between, rewritten, lambda a, b: F.concat(a, b)), "")


def expand_units(text: Column) -> Column:
    """Write unit symbols out as words. Case-sensitive, so it precedes
    lower-casing."""
    words = _literal_map(_UNIT_WORDS)
    spelled = F.when(
        text.rlike(_UNIT),
        _swap_matches(text, _UNIT, lambda u: F.concat(F.lit(" "), words[u], F.lit(" "))),
    ).otherwise(text)
    degrees = spelled
    for scale, phrase in DEGREES.items():
        degrees = F.regexp_replace(
            degrees, f"({DIGIT})[{SPACE}]*°[{SPACE}]*{scale}{NOT_BEFORE_WORD}", f"$1 {phrase}"
        )
    return F.when(text.contains("°"), degrees).otherwise(spelled)


def lower_case(text: Column) -> Column:
    return F.lower(text)


def _expand(text: Column) -> Column:
    """Only the few words with an apostrophe are searched for contractions."""
    long_forms = _literal_map(CONTRACTIONS)

    def long_form(match: Column) -> Column:
        return F.coalesce(F.try_element_at(long_forms, F.translate(match, "’", "'")), match)

    def expand_word(word: Column) -> Column:
        return F.when(_has_apostrophe(word), _swap_matches(word, _CONTRACTION, long_form)).otherwise(word)

    return F.array_join(F.transform(F.split(text, " ", -1), expand_word), " ")


def _has_apostrophe(text: Column) -> Column:
    return text.contains("'") | text.contains("’")


def expand_contractions(text: Column) -> Column:
    """Long forms for known contractions; whitespace runs become one space."""
    spaced = collapse_whitespace(text)
    return F.when(_has_apostrophe(text), _expand(spaced)).otherwise(spaced)


# The patterns of the steps below, and what takes their place, must match what users of the
# cleaning chain rely on.


def remove_usernames(text: Column) -> Column:
    return F.regexp_replace(text, f"@[{WORD}]+", " ")


def isolate_punctuation(text: Column) -> Column:
    """Set ``.`` ``?`` ``/`` apart by spaces, keep ``%`` and ``-`` in place and turn
    every other symbol into spaces."""
    apart = F.regexp_replace(text, r"""(['".()!?\\/,])""", " $1 ")
    return strip_copyright(F.regexp_replace(apart, rf"[^{WORD}{SPACE}?%/.\-]", " "))


def strip_copyright(text: Column) -> Column:
    """Drop a notice from ``©`` to the first four-digit year with a full stop.
    ``(?d)`` lets only a newline stop the dot."""
    return F.regexp_replace(text, rf"(?d)©.*?{DIGIT}{{4}}\.", " ")


def remove_emojis(text: Column) -> Column:
    return F.regexp_replace(text, rf"(?![\x00-\xff])[{EMOJI}]+", "")


def collapse_repeats(text: Column) -> Column:
    """A run of ``!``, ``?`` and ``.`` becomes its last character."""
    return F.regexp_replace(text, r"([!?.]){2,}", "$1")


def remove_numbers(text: Column) -> Column:
    return F.regexp_replace(text, rf"{WORD_EDGE}{DIGIT}+\.?{DIGIT}*{WORD_EDGE}", " ")


def remove_special(text: Column) -> Column:
    return F.regexp_replace(text, r"[;:|•«\n]", " ")


def collapse_whitespace(text: Column) -> Column:
    """Whitespace runs become one space, none at the ends. A lone space is already
    what it should be and is not matched."""
    return F.trim(F.regexp_replace(text, _SPACE_RUN, " "))


def clean_text_by_steps(text: Column, drop_numbers: bool = False) -> Column:
    """The chain as the plain sequence of the functions above. It defines what
    ``clean_text`` must return."""
    steps = [
        expand_units,
        lower_case,
        expand_contractions,
        remove_usernames,
        isolate_punctuation,
        remove_emojis,
        collapse_repeats,
        *([remove_numbers] if drop_numbers else []),
        remove_special,
        collapse_whitespace,
    ]
    for step in steps:
        text = step(text)
    return text


def clean_text(text: Column, drop_numbers: bool = False) -> Column:
    """The chain in as few passes over the text as give the same result.

    User names and unwanted symbols all end as spaces, so one pattern takes both.
    The copyright and repeat steps find nothing once symbols are gone and the kept
    marks stand apart, and the special characters are among the removed symbols;
    whitespace needs collapsing only once, at the end.
    """
    lowered = lower_case(expand_units(text))
    expanded = F.when(_has_apostrophe(text), _expand(lowered)).otherwise(lowered)
    bare = F.regexp_replace(expanded, rf"@[{WORD}]*|[^@{WORD}{SPACE}?%/.\-]+", " ")
    apart = F.regexp_replace(bare, "([.?/])", " $1 ")
    kept = remove_emojis(apart)
    if drop_numbers:
        kept = remove_numbers(kept)
    return collapse_whitespace(kept)
