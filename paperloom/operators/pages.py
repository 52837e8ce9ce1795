"""Ranked listings that are asked for page by page."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.limits import PAGE_SIZE
from paperloom.operators.rank import ranked

# Hits in one folder, a multiple of a page: a page never lies in two.
HITS_A_CHUNK = 400 * PAGE_SIZE


def _chunk(rank: Column) -> Column:
    return F.floor((rank - 1) / HITS_A_CHUNK).cast("long")


class PageStore:
    """A listing ranked once and stored by search and run of ranks. Where a rank lies follows from the
    rank itself, so a page request reads one folder, whatever the listing's size."""

    def __init__(self, spark: SparkSession, path: str, by: str = "year"):
        self.spark = spark
        self.path = path
        self.by = by

    def write(self, listing: DataFrame, order_by: list[Column]) -> PageStore:
        hits = ranked(listing, order_by, (self.by,)).withColumn("chunk", _chunk(F.col("rank")))
        placed = hits.hint("rebalance", self.by, "chunk").sortWithinPartitions(self.by, "chunk", "rank")
        placed.write.mode("overwrite").partitionBy(self.by, "chunk").parquet(self.path)
        totals = listing.groupBy(self.by).agg(F.count(F.lit(1)).alias("total_results"))
        totals.write.mode("overwrite").parquet(f"{self.path}-totals")
        return self

    def page(self, search, start: int, size: int = PAGE_SIZE) -> DataFrame:
        """The hits after the first ``start`` of a search, with ``page``, ``start`` and
        ``total_results``; at most ``size``, which must lie within a page."""
        if start % PAGE_SIZE + size > PAGE_SIZE:
            raise ValueError("a request reaches over the end of its page")
        hits = self.spark.read.parquet(self.path)
        inside = (F.col(self.by) == search) & (F.col("chunk") == start // HITS_A_CHUNK)
        found = hits.filter(inside & F.col("rank").between(start + 1, start + size)).drop("chunk")
        totals = self.spark.read.parquet(f"{self.path}-totals")
        numbers = {"page": F.lit(start // PAGE_SIZE), "start": F.lit(start)}
        return found.withColumns(numbers).join(totals, self.by)
