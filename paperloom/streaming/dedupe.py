"""One row of each key of a stream, out of Spark's state store.

Two streams, one after the other. The first sorts out what comes too late: a row is late if its
time is not after the highest time of all earlier micro-batches less the delay. Late rows, and
rows without a key or a time, are kept apart as rejects. The second drops repeated keys;
its state holds the keys of one delay, whatever the target has become, and the target is never read.

The first stream is never less strict than the watermark of the second, so that one loses nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Observation, SparkSession, functions as F, types as T

EVENT_TIME = "_event_time"
MARKS = "high long, batch_id long"
LAYOUT = "batch_id long, late boolean"


def _event_time(time: str) -> Column:
    return F.col(time).cast("timestamp")


def _with_layout(spark: SparkSession, schema: T.StructType) -> T.StructType:
    layout = spark.createDataFrame([], LAYOUT).schema
    return T.StructType([*schema.fields, *layout.fields])


def sort_out_late(stream: DataFrame, key: str, time: str, delay: str, path: str, checkpoint: str) -> None:
    """Store what has arrived under ``path/events`` by micro-batch and ``late``, then stop.

    The highest time of each micro-batch is one row under ``path/marks``. A repeated micro-batch
    sees the same marks and replaces its own files alone.
    """
    spark = stream.sparkSession
    layout = _with_layout(spark, stream.schema)
    spark.createDataFrame([], MARKS).write.mode("ignore").partitionBy("batch_id").parquet(f"{path}/marks")
    spark.createDataFrame([], layout).write.mode("ignore").partitionBy("batch_id", "late").parquet(f"{path}/events")

    def load(batch: DataFrame, batch_id: int) -> None:
        session = batch.sparkSession
        marks = session.read.schema(MARKS).parquet(f"{path}/marks").filter(F.col("batch_id") < batch_id)
        mark = F.timestamp_micros(F.lit(marks.agg(F.max("high")).first()[0]).cast("long"))
        at = _event_time(time)
        late = F.coalesce(at <= mark - F.expr(f"INTERVAL {delay}"), F.lit(False)) | at.isNull() | F.col(key).isNull()
        seen = Observation()
        watched = batch.observe(seen, F.max(F.unix_micros(at)).alias("high"))
        own = watched.withColumn("late", late).write.mode("overwrite").partitionBy("late")
        own.parquet(f"{path}/events/batch_id={batch_id}")
        high = session.createDataFrame([(seen.get["high"],)], "high long")
        high.coalesce(1).write.mode("overwrite").parquet(f"{path}/marks/batch_id={batch_id}")

    _run(stream.writeStream.foreachBatch(load), checkpoint)


def dedupe_stream(
    stream: DataFrame, key: str, time: str, delay: str, path: str, checkpoint: str
) -> tuple[DataFrame, DataFrame]:
    """Process what has arrived, then stop; returns (rows, rejects) of all that ever arrived: one
    row of each ``key`` that came in time, and every row that came late or has no key or time.

    Copies that are at most ``delay`` (such as ``1 day``) apart in time are found. Large states
    want the RocksDB state store, which the session names.
    """
    spark, schema = stream.sparkSession, stream.schema
    sort_out_late(stream, key, time, delay, path, f"{checkpoint}/late")
    on_time = spark.readStream.schema(schema).parquet(f"{path}/events/batch_id=*/late=false")
    timed = on_time.withColumn(EVENT_TIME, _event_time(time)).withWatermark(EVENT_TIME, delay)
    once = timed.dropDuplicatesWithinWatermark([key]).drop(EVENT_TIME)
    _run(once.writeStream.format("parquet").option("path", f"{path}/rows"), f"{checkpoint}/once")
    events = spark.read.schema(_with_layout(spark, schema)).parquet(f"{path}/events")
    return spark.read.schema(schema).parquet(f"{path}/rows"), events.filter("late").select(*schema.names)


def _run(writer, checkpoint: str) -> None:
    writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start().awaitTermination()
