"""What several operators share: whole-text columns, row keys, filtering of wide rows, connected components."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.session import ship_package, stage_table, tune

# Fixed value: the white space that all contracts name.
SPACE = r"[\x20\x09-\x0D]"


# Rows that go to a Python worker at once: rows hold whole texts, of which Spark's own default of
# 10,000 makes batches of tens of megabytes in the executor and again in the worker.
ROWS_PER_BATCH = 1000


def prepared(spark: SparkSession) -> SparkSession:
    """The session with the settings that the operators count on."""
    tune(ship_package(spark))
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(ROWS_PER_BATCH))
    return spark


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def whole_text(column: str = "text") -> Column:
    """The whole text; null counts as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def numbered(rows: DataFrame, name: str) -> DataFrame:
    """``rows`` written to the shared folder with a ``row_id`` that no longer changes."""
    return stage_table(rows.withColumn("row_id", F.monotonically_increasing_id()), name)


def drop_rows(docs: DataFrame, key: list[Column], dropped: DataFrame, repeated: DataFrame) -> DataFrame:
    """``docs`` without the rows whose key is in ``dropped``, and one row of each key in
    ``repeated`` (identical rows, which no key can tell apart).

    The rows travel as one struct, so that no column name can clash. ``dropped`` grows with the
    data, so it is never broadcast: rows and keys meet in a sort-merge join at every size.
    ``repeated`` is joined as Spark's size check decides.
    """
    keys = [f"key{i}" for i in range(len(key))]
    rows = docs.select(F.struct("*").alias("row"), *[c.alias(k) for c, k in zip(key, keys)])

    def join(left: DataFrame, right: DataFrame, kind: str) -> DataFrame:
        other = right.toDF(*[f"other{i}" for i in range(len(keys))])
        on = [F.col(k).eqNullSafe(F.col(o)) for k, o in zip(keys, other.columns)]
        return left.join(other, on, kind)

    left = join(rows, dropped.hint("merge"), "left_anti")
    once = join(left, repeated, "left_anti")
    again = join(left, repeated, "left_semi").dropDuplicates(keys)
    return once.unionByName(again).select("row.*")


def components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: long): root is the smallest node that
    can be reached.

    Alternates two steps until nothing changes: every node ties its larger neighbours to the
    smallest one around it, then ties its smaller neighbours to the smallest of them. Minima
    are pre-aggregated before the shuffle and the links of a node that gathers many are split
    by Spark's skew join, so no task holds a whole component. Each round is a written table.
    """
    largest, least = F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")
    edges = stage_table(links.filter("a <> b").select(largest, least).distinct(), "links")
    state = None
    while True:
        now = edges.agg(
            F.count(F.lit(1)).alias("n"),
            F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("sum"),
        ).first()
        if now == state:
            break
        state = now
        edges = stage_table(_tie_smaller(_tie_larger(edges)), "links")
    tied = edges.select(F.col("a").alias("node"), F.col("b").alias("root"))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return tied.unionByName(roots)


def _tie_larger(edges: DataFrame) -> DataFrame:
    around = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    smallest = around.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
    larger = around.filter("b > a").join(smallest, "a")
    return larger.select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _tie_smaller(edges: DataFrame) -> DataFrame:
    smallest = edges.groupBy("a").agg(F.min("b").alias("m"))
    joined = edges.join(smallest, "a")
    moved = joined.filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    kept = smallest.select("a", F.col("m").alias("b"))
    return moved.unionByName(kept).distinct()
