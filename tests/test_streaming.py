"""Incremental loads against the batch result."""

import uuid

from pyspark.sql import functions as F

from paperloom.session import scratch_path
from paperloom.sinks.tables import TablePlace
from paperloom.streaming import dedupe, incremental

SCHEMA = "article_id long, title string"


def place(spark):
    return TablePlace(f"s_{uuid.uuid4().hex}", scratch_path(spark, "out"))


def arrive(spark, path, rows):
    spark.createDataFrame(rows, SCHEMA).coalesce(1).write.mode("append").parquet(path)


def stream(spark, path, files=None):
    return incremental.file_stream(spark, path, SCHEMA, files_per_batch=files)


def first(spark, source, target, checkpoint, files=1):
    loaded = incremental.load_first(stream(spark, source, files), "article_id", ["title"], target, checkpoint)
    return sorted((r.article_id, r.title) for r in loaded.collect())


def test_overlapping_batches_in_any_order(spark):
    source, checkpoint, target = scratch_path(spark, "in"), scratch_path(spark, "cp"), place(spark)
    arrive(spark, source, [(1, "b"), (1, "c"), (2, "c"), (None, "x")])
    assert first(spark, source, target, checkpoint) == [(1, "b"), (2, "c")]
    arrive(spark, source, [(2, "b"), (3, "d"), (1, "z")])
    arrive(spark, source, [(3, "e"), (4, "e"), (1, "a"), (2, "a")])
    want = [(1, "a"), (2, "a"), (3, "d"), (4, "e")]
    assert first(spark, source, target, checkpoint) == want
    assert first(spark, source, target, checkpoint) == want
    assert first(spark, source, place(spark), scratch_path(spark, "cp"), None) == want


def test_new_checkpoint_and_new_source_leave_earlier_rows(spark):
    target = place(spark)
    for rows, want in (([(1, "a"), (2, "c")], [1, 2]), ([(3, "d"), (2, "b")], [1, 2, 3]), ([(4, "e")], [1, 2, 3, 4])):
        source = scratch_path(spark, "in")
        arrive(spark, source, rows)
        assert [k for k, _ in first(spark, source, target, scratch_path(spark, "cp"))] == want


def test_a_batch_run_again_replaces_its_own_output(spark):
    source, target = scratch_path(spark, "in"), place(spark)
    arrive(spark, source, [(1, "a"), (2, "c")])
    for _ in range(2):  # a lost checkpoint makes the stream start over
        loaded = incremental.load_new(stream(spark, source), "article_id", target, scratch_path(spark, "cp"))
    assert sorted(r.article_id for r in loaded.collect()) == [1, 2]


def test_copies_in_many_files_come_once(spark):
    source, checkpoint, target = scratch_path(spark, "in"), scratch_path(spark, "cp"), place(spark)
    for start in (40, 0, 20):
        arrive(spark, source, [(i, "same") for i in range(start, start + 30)])
    loaded = incremental.load_new(stream(spark, source, 1), "article_id", target, checkpoint)
    assert sorted(r.article_id for r in loaded.collect()) == list(range(70))


EVENTS = "event_id long, ts timestamp_ntz, what string"


def events(spark, path, *rows):
    rows = [(i, None if day is None else f"2024-01-{day:02} 00:00:00", what) for i, day, what in rows]
    table = spark.createDataFrame(rows, "event_id long, ts string, what string")
    table.withColumn("ts", F.col("ts").cast("timestamp_ntz")).coalesce(1).write.mode("append").parquet(path)


def once(spark, source, path, checkpoint):
    stream = incremental.file_stream(spark, source, EVENTS, files_per_batch=1)
    rows, rejects = dedupe.dedupe_stream(stream, "event_id", "ts", "2 days", path, checkpoint)
    return [sorted((r.event_id, r.what) for r in df.collect()) if df is rows else sorted(r.what for r in df.collect()) for df in (rows, rejects)]


def test_state_survives_restarts_and_late_rows_are_kept_apart(spark):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    events(spark, source, (1, 1, "a"), (1, 1, "a"), (2, 1, "b"), (None, 1, "no key"), (3, None, "no time"))
    assert once(spark, source, path, checkpoint) == [[(1, "a"), (2, "b")], ["no key", "no time"]]
    events(spark, source, (2, 1, "b"), (4, 2, "d"), (5, 9, "e"))
    events(spark, source, (1, 1, "a"), (6, 7, "at the mark"), (7, 8, "f"), (5, 9, "e"))
    want = [[(1, "a"), (2, "b"), (4, "d"), (5, "e"), (7, "f")], ["a", "at the mark", "no key", "no time"]]
    for _ in range(2):
        assert once(spark, source, path, checkpoint) == want


def test_nothing_has_arrived(spark):
    source, path, checkpoint = (scratch_path(spark, n) for n in ("in", "out", "cp"))
    spark.createDataFrame([], EVENTS).write.parquet(source)
    assert once(spark, source, path, checkpoint) == [[], []]

