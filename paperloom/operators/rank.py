"""Exact ranks of all rows, the harvest and result pages, without a task that holds a group."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.limits import PAGE_SIZE
from paperloom.operators.dedupe import first_per_key
from paperloom.session import stage_table

_ROW_BITS = 33


def ranked(df: DataFrame, order_by: list[Column], by: tuple[str, ...] = (), rank_col: str = "rank") -> DataFrame:
    """Every row with its rank from 1 in its group. ``order_by`` must end in a unique column
    to fix the result.

    Rows are range-partitioned by group and order, sorted inside their partition and written
    once with ``monotonically_increasing_id``, which holds partition and position. What is
    summed over all partitions is one row per partition and group that meets it.
    """
    order = [*[F.col(c) for c in by], *order_by]
    sorted_rows = df.repartitionByRange(*order).sortWithinPartitions(*order)
    staged = stage_table(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "ranked")
    part = F.shiftright("_place", _ROW_BITS)
    row = F.col("_place").bitwiseAND(F.lit((1 << _ROW_BITS) - 1))
    counts = staged.groupBy(*by, part.alias("_part")).agg(F.count(F.lit(1)).alias("_rows"), F.min(row).alias("_first"))
    earlier = Window.partitionBy(*by).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = F.coalesce(F.sum("_rows").over(earlier), F.lit(0)) - F.col("_first")
    other = counts.select(*[F.col(c).alias(f"_by_{c}") for c in by], F.col("_part").alias("_of"), before.alias("_before"))
    on = F.col("_part") == F.col("_of")
    for c in by:
        on = on & F.col(c).eqNullSafe(F.col(f"_by_{c}"))
    joined = staged.withColumn("_part", part).join(other, on)
    return joined.select(*df.columns, (F.col("_before") + row + 1).alias(rank_col))


def offsets(df: DataFrame, key: str, size: str, start: str) -> DataFrame:
    """``df`` (unique ``key``) with the sum of ``size`` over all smaller keys. As in ``ranked``, what is summed
    over all partitions is one row per partition."""
    sorted_rows = df.repartitionByRange(key).sortWithinPartitions(key)
    staged = stage_table(sorted_rows.withColumn("_place", F.monotonically_increasing_id()), "offsets")
    part = F.shiftright("_place", _ROW_BITS)
    sums = staged.groupBy(part.alias("_of")).agg(F.sum(size).alias("_sum"))
    earlier = Window.orderBy("_of").rowsBetween(Window.unboundedPreceding, -1)
    before = sums.select("_of", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_before"))
    inside = Window.partitionBy("_part").orderBy("_place").rowsBetween(Window.unboundedPreceding, -1)
    running = staged.withColumn("_part", part).withColumn("_inside", F.coalesce(F.sum(size).over(inside), F.lit(0)))
    joined = running.join(before, F.col("_part") == F.col("_of"))
    return joined.select(*df.columns, (F.col("_before") + F.col("_inside")).alias(start))


def top_n(df: DataFrame, n: int, order_by: list[Column], by: tuple[str, ...] = (), rank_col: str = "rank") -> DataFrame:
    """The first ``n`` rows of each group with their rank; ``n`` is the caller's choice."""
    return ranked(df, order_by, by, rank_col).filter(F.col(rank_col) <= n)


def harvested(
    listing: DataFrame,
    order_by: list[Column],
    cap: int | None = None,
    year: str | None = "year",
    has_keywords: str = "has_keywords",
) -> DataFrame:
    """The rows with keywords that a harvest keeps: all of them, or, where the caller sets a
    ``cap``, the first ``cap`` in the order of the visit (year by year, each in ``order_by``).
    Once the cap is reached a later year still has its first row visited.

    The visit needs no running count: the first rows of the whole order and the first row of
    each year are both cut in every task before a shuffle.
    """
    keeping = listing.filter(F.col(has_keywords))
    if cap is None:
        return keeping
    if year is None:
        return keeping.orderBy(*order_by).limit(cap)
    first = stage_table(keeping.orderBy(year, *order_by).limit(cap), "first-rows")
    heads = first_per_key(listing, [year], order_by).filter(F.col(has_keywords))
    # A head that is among the first rows is not taken twice: years up to the last one of these
    # are visited from their beginning. Equal hits stay as many rows as they are.
    reached = first.agg(F.max(year)).first()[0]
    later = heads if reached is None else heads.filter(F.col(year) > reached)
    return first.unionByName(later)


def result_pages(listing: DataFrame, order_by: list[Column], page_size: int = PAGE_SIZE) -> DataFrame:
    """All results of a search in order, with rank, page number, start offset and the total
    number of hits."""
    page = F.floor((F.col("rank") - 1) / page_size)
    total = listing.agg(F.count(F.lit(1))).scalar()
    return (
        ranked(listing, order_by)
        .withColumn("page", page)
        .withColumn("start", F.col("page") * page_size)
        .withColumn("total_results", total)
    )
