"""Incremental loads as streams, whose result does not depend on how rows come in files."""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.operators.dedupe import first_per_key, once_per_key, with_keys
from paperloom.session import stage_table
from paperloom.sinks.tables import BucketTable, TablePlace

PARTS = "load_id string, batch_id long"


def file_stream(
    spark: SparkSession, path: str, schema, pattern: str = "*", files_per_batch: int | None = None
) -> DataFrame:
    """New parquet files under ``path`` as a stream; ``files_per_batch`` is what one
    micro-batch takes, None leaves it to Spark."""
    reader = spark.readStream.schema(schema).option("pathGlobFilter", pattern)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_id(spark: SparkSession, checkpoint: str) -> str:
    """The id that Spark gives a checkpoint once and for all."""
    return json.loads(spark.read.text(f"{checkpoint}/metadata").first()[0])["id"]


def load_first(
    stream: DataFrame,
    key: str,
    order_by: list[str],
    place: TablePlace,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataFrame:
    """Process what has arrived, then stop; returns the table of the first row of each key in
    ``order_by`` (unique, no NULL) over all that ever arrived, in whatever order and batches.

    A micro-batch adds its own first rows where they come before what the target has, and
    never rewrites a row. It owns the part ``load_id=<checkpoint>, batch_id=N`` and
    compares itself with all others, so running it again after a failure replaces its
    own output alone, and a new checkpoint leaves all earlier rows in place. The target lies in
    buckets of the key, so only the keys and the order of the batch are shuffled to it. Rows without a
    key are not loaded.
    """
    spark = stream.sparkSession
    columns = prepare(spark.createDataFrame([], stream.schema)).schema
    table = BucketTable(spark, place, columns, key, PARTS).create()

    def first(rows: DataFrame) -> DataFrame:
        return first_per_key(rows, [key], [F.col(c) for c in order_by])

    def load(batch: DataFrame, batch_id: int) -> None:
        own = stream_id(spark, checkpoint)
        session = batch.sparkSession
        landed = stage_table(prepare(batch).filter(F.col(key).isNotNull()), "micro-batch")
        rows = once_per_key(landed, key, first)
        session.catalog.refreshTable(place.name)
        others = ~((F.col("load_id") == own) & (F.col("batch_id") == batch_id))
        held = session.table(place.name).filter(others)
        order = F.struct(*order_by)
        best = held.groupBy(F.col(key).alias("_key")).agg(F.min(order).alias("_best"))
        # Keys and order alone meet the target, in as many tasks as it has buckets.
        asked = rows.select(key, order.alias("_order")).join(best, F.col(key) == F.col("_key"))
        late = stage_table(asked.filter(F.col("_order") >= F.col("_best")).select(key), "late-keys")
        fresh = with_keys(rows, key, late, "left_anti")
        table.replace_part(fresh, load_id=own, batch_id=batch_id)

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    table.grow()
    return first(table.read())


def load_new(
    stream: DataFrame,
    key: str,
    place: TablePlace,
    checkpoint: str,
    prepare: Callable[[DataFrame], DataFrame] = lambda batch: batch,
) -> DataFrame:
    """One row of each key over all that arrived: the first by a hash of the row, which ties
    copies and versions of a key whatever file they come in."""

    def hashed(batch: DataFrame) -> DataFrame:
        rows = prepare(batch)
        return rows.withColumn("_row_hash", F.sha2(F.to_json(F.struct(*rows.columns)), 256))

    return load_first(stream, key, ["_row_hash"], place, checkpoint, hashed).drop("_row_hash")
