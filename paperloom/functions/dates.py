"""Dates in long English form and epoch seconds."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from paperloom.functions.charsets import SPACE

# Accepted layouts, with the shape each one must have in full.
LAYOUTS = {
    "d MMMM yyyy": r"^[0-9]{1,2} \p{L}+ [0-9]{4}$",
    "MMMM d, yyyy": r"^\p{L}+ [0-9]{1,2}, [0-9]{4}$",
}


def parse_long_date(text: Column) -> Column:
    spaced = F.regexp_replace(text, f"[{SPACE}]+", " ")
    return F.coalesce(
        *[F.when(spaced.rlike(shape), F.try_to_date(spaced, layout)) for layout, shape in LAYOUTS.items()]
    )


def is_long_date(text: Column) -> Column:
    return parse_long_date(text).isNotNull()


def to_iso_date(text: Column) -> Column:
    return F.date_format(parse_long_date(text), "yyyy-MM-dd")


def epoch_to_timestamp(seconds: Column) -> Column:
    return F.timestamp_seconds(seconds)


def to_double(text: Column) -> Column:
    return text.cast("double")
