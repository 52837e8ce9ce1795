"""Rating counts and averages per title."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F


def ratings_per_title(ratings: DataFrame, titles: DataFrame, key: str, decimals: int | None = None) -> DataFrame:
    """Join ratings (``key``, ``timestamp``, ``rating``) with titles (unique ``key``,
    ``title``) and return count and mean per title.

    Counts and sums are taken per key before the join: the join then sees one row
    per key, however many ratings a key has.
    """
    per_key = ratings.groupBy(key).agg(
        F.count("timestamp").alias("_stamps"), F.sum("rating").alias("_sum"), F.count("rating").alias("_ratings")
    )
    average = F.sum("_sum") / F.nullif(F.sum("_ratings"), F.lit(0))
    return (
        per_key.join(titles.select(key, "title"), key)
        .groupBy("title")
        .agg(
            F.sum("_stamps").alias("qty_ratings"),
            (average if decimals is None else F.round(average, decimals)).alias("avg_rating"),
        )
    )


def most_rated(per_title: DataFrame, n: int = 10) -> DataFrame:
    return per_title.orderBy(F.desc("qty_ratings"), "title").limit(n)
