"""One row per key."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.session import stage_table

# So many keys are sent to every task; for more of them the rows are shuffled.
KEYS_SENT = 200_000


def any_per_key(df: DataFrame, *keys: str) -> DataFrame:
    """Whichever row of a key; right where only the number of rows matters."""
    return df.dropDuplicates(list(keys))


def first_per_key(df: DataFrame, keys: list[str], order_by: list[Column]) -> DataFrame:
    """The first row of each key in ``order_by``.

    The rank filter lets Spark cut every map task to one row per key before the
    shuffle (WindowGroupLimit), so a key that holds a third of the rows sends one row
    per task, not all of them.
    """
    ranked = df.withColumn("_rank", F.row_number().over(Window.partitionBy(*keys).orderBy(*order_by)))
    return ranked.filter(F.col("_rank") == 1).drop("_rank")


def with_keys(rows: DataFrame, key: str, keys: DataFrame, how: str) -> DataFrame:
    """``rows`` whose ``key`` is among ``keys`` (``left_semi``) or not (``left_anti``). ``keys`` is a staged
    table of one column; NULL is a key like any other. Rows stay in their tasks while the keys are few."""
    found = keys.toDF("_key")
    if keys.count() <= KEYS_SENT:
        found = F.broadcast(found)
    return rows.join(found, F.col(key).eqNullSafe(F.col("_key")), how)


def once_per_key(landed: DataFrame, key: str, choose: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """One row per key. ``choose`` says which where there are several, and sees those rows alone: rows with
    a key of their own are neither shuffled nor sorted. ``landed`` is read more than once, so it
    should be a table; where many keys are repeated, ``choose`` sees all rows."""
    counts = landed.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    repeated = stage_table(counts.select(key), "repeated-keys")
    n = repeated.count()
    if n == 0:
        return landed
    if n > KEYS_SENT:
        return choose(landed)
    alone, chosen = (with_keys(landed, key, repeated, how) for how in ("left_anti", "left_semi"))
    return alone.unionByName(choose(chosen))


def latest_articles(articles: DataFrame) -> DataFrame:
    """One row per article: the latest date, then every other column as tie-break,
    so the survivor does not depend on how the rows arrived."""
    order = [F.col("publish_date").desc_nulls_last(), F.col("title")] + [
        F.col(c) for c in articles.columns if c not in ("article_id", "publish_date", "title")
    ]
    return first_per_key(articles, ["article_id"], order)


def identified(articles: DataFrame) -> DataFrame:
    """The articles with an identifier."""
    return articles.filter(F.coalesce(F.col("article_id") != 0, F.lit(False)))


def unidentified(articles: DataFrame) -> DataFrame:
    """Articles whose id is NULL or 0 (none found): they are no versions of one article, so they
    are rejected before a load, not folded."""
    return articles.filter(F.coalesce(F.col("article_id") == 0, F.lit(True)))
