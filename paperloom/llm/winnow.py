"""Document fingerprints by winnowing.

The characters of a text, without white space and with A-Z in lower case, are hashed in every
run of ``GRAM`` of them by a rolling polynomial. Of every window of ``WINDOW`` consecutive
hashes the smallest is chosen, the rightmost one of equal ones, and kept with the position of
its first character. Two texts that share ``GRAM + WINDOW - 1`` characters in a row share at
least one chosen hash.

Defined cases: a null text is empty; an empty text has no hashes, a shorter one than a gram
has the hash of all it has; likeness is the share of common hashes among all of both, 1 for
two texts without any; equal texts have equal fingerprints; documents with a null doc_id come
last; a single document is its own neighbour; an empty table gives an empty result; other
columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from paperloom.llm.common import whole_text
from paperloom.session import stage_table

GRAM = 16
WINDOW = 32
# Odd multipliers of the rolling hash and of its final mix.
ROLL = 0x9E3779B97F4A7C15
MIX = np.uint64(0xFF51AFD7ED558CCD)

Prints = tuple[np.ndarray, np.ndarray]


def kept_characters(text: str) -> Prints:
    """(codes, positions) of what is hashed."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), "<u4").astype(np.uint64)
    positions = np.flatnonzero((codes != 32) & ((codes < 9) | (codes > 13)))
    codes = codes[positions]
    codes[(codes >= 65) & (codes <= 90)] += np.uint64(32)
    return codes, positions


def rolling_hashes(codes: np.ndarray) -> np.ndarray:
    """Hash of every run of ``GRAM`` codes: runs of 1, 2, 4, ... are put together pairwise."""
    found, length, factor = codes, 1, ROLL
    while length < GRAM:
        found = found[:-length] * np.uint64(factor) + found[length:]
        factor = factor * factor % (1 << 64)
        length *= 2
    found = (found ^ (found >> np.uint64(33))) * MIX
    return found ^ (found >> np.uint64(29))


def chosen(hashes: np.ndarray) -> np.ndarray:
    """Places of the window minima, the rightmost of equal ones; a shorter list is one window."""
    window = min(WINDOW, len(hashes))
    least, place, length = hashes, np.arange(len(hashes)), 1
    while length < window:
        step = min(length, window - length)
        right = least[step:] <= least[:-step]
        place = np.where(right, place[step:], place[:-step])
        least = np.where(right, least[step:], least[:-step])
        length += step
    return place[np.concatenate([[True], place[1:] != place[:-1]])]


def winnow(text: str) -> Prints:
    """(hashes, positions) of the chosen grams, in the order of the text."""
    codes, positions = kept_characters(text)
    if not len(codes):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if len(codes) < GRAM:
        codes = np.concatenate([codes, np.zeros(GRAM - len(codes), np.uint64)])
    hashes = rolling_hashes(codes)
    at = chosen(hashes)
    return hashes[at], positions[at]


def likeness(a: np.ndarray, b: np.ndarray) -> float:
    """Common hashes by all hashes of two sorted arrays without repeats."""
    if not len(a) and not len(b):
        return 1.0
    common = len(np.intersect1d(a, b, assume_unique=True))
    return common / (len(a) + len(b) - common)


def digest(hashes: np.ndarray) -> str:
    return hashlib.sha256(hashes.astype("<u8").tobytes()).hexdigest()[:32]


def fingerprints(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns, and the chosen ``hashes`` and ``positions`` of every whole text."""
    rows = docs.select(F.struct(*keep).alias("kept"), whole_text().alias("text"))
    schema = rows.schema["kept"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, 256):
                part = batch.slice(start, 256)
                found = [winnow(t) for t in part.column(1).to_pylist()]
                hashes = pa.array([h.view(np.int64) for h, _ in found], pa.list_(pa.int64()))
                positions = pa.array([p for _, p in found], pa.list_(pa.int64()))
                yield pa.record_batch([part.column(0), hashes, positions], ["kept", "hashes", "positions"])

    out = f"kept {schema}, hashes array<long>, positions array<long>"
    return rows.mapInArrow(run, out).select("kept.*", "hashes", "positions")


# --- each document beside its neighbour ---------------------------------------------------


class _Document:
    def __init__(self, doc_id: int | None, text: str) -> None:
        self.doc_id, self.text = doc_id, text
        self.hashes, _ = winnow(text)
        self.distinct = np.unique(self.hashes)

    def beside(self, following: _Document) -> tuple:
        half = len(self.text) // 2
        edited = self.text[: len(self.text) - half] + following.text[:half]
        hashes, _ = winnow(edited)
        return (
            self.doc_id,
            len(self.text),
            hashlib.sha256(edited.encode()).hexdigest(),
            digest(self.hashes),
            digest(hashes),
            likeness(self.distinct, np.unique(hashes)),
            likeness(self.distinct, following.distinct),
        )


COMPARED = {
    "doc_id": "long",
    "n_chars": "long",
    "edited_sha256": "string",
    "fingerprint": "string",
    "edited_fingerprint": "string",
    "near_edited": "double",
    "near_next": "double",
}
# The ends of a partition: its first and its last text wait for the partitions around it.
ENDS = {"part": "int", "end": "string", "text": "string"}


def _schema(columns: dict[str, str]) -> str:
    return ", ".join(f"{name} {kind}" for name, kind in columns.items())


def _batch(rows: list[tuple], names: list[str], arrow: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, t) for c, t in zip(zip(*rows), arrow.types)], names)


_ARROW = {"long": pa.int64(), "int": pa.int32(), "string": pa.string(), "double": pa.float64()}


def _compare_in_order(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (doc_id, text) of one partition in order: each beside the next one, and the ends."""
    columns = COMPARED | ENDS
    arrow = pa.schema([(n, _ARROW[k]) for n, k in columns.items()])
    part, last = TaskContext.get().partitionId(), None
    blank = (None,) * (len(COMPARED) - 1)
    for batch in batches:
        for start in range(0, batch.num_rows, 64):
            rows = []
            some = batch.slice(start, 64)
            for doc_id, text in zip(some.column(0).to_pylist(), some.column(1).to_pylist()):
                now = _Document(doc_id, text)
                if last is None:
                    rows.append((doc_id, *blank, part, "first", text))
                else:
                    rows.append((*last.beside(now), part, None, None))
                last = now
            if rows:
                yield _batch(rows, list(columns), arrow)
    if last is not None:
        yield _batch([(last.doc_id, *blank, part, "last", last.text)], list(columns), arrow)


def _compare_pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    arrow = pa.schema([(n, _ARROW[k]) for n, k in COMPARED.items()])
    for batch in batches:
        for row in batch.to_pylist():
            found = _Document(row["doc_id"], row["text"]).beside(_Document(None, row["next_text"]))
            yield _batch([found], list(COMPARED), arrow)


def compare_neighbours(docs: DataFrame, parts: int | None = None) -> DataFrame:
    """Every document with its edited text and its successor by descending doc_id (the first
    one follows the last): one row per row of ``docs``.

    The texts move once, into ranges of doc_id sorted inside; equal ids are told apart by a hash of
    the text. What crosses the border of two ranges is one text on each side.
    """
    spark = docs.sparkSession
    parts = parts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = docs.select(F.col("doc_id").cast("long"), whole_text().alias("text"))
    order = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    ranged = rows.repartitionByRange(parts, *order).sortWithinPartitions(*order)
    compared = ranged.mapInArrow(_compare_in_order, _schema(COMPARED | ENDS))
    compared = stage_table(compared, "neighbours")
    ends = compared.filter(F.col("end").isNotNull())
    # One number per range, to find the next range that has rows.
    every = Window.orderBy("part")
    numbers = ends.filter("end = 'first'").select("part")
    first = numbers.agg(F.min("part")).first()[0]
    follows = numbers.select("part", F.coalesce(F.lead("part").over(every), F.lit(first)).alias("next_part"))
    heads = ends.filter("end = 'first'").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    tails = ends.filter("end = 'last'").select("part", "doc_id", "text").join(follows, "part").join(heads, "next_part")
    bordering = tails.select("doc_id", "text", "next_text").mapInArrow(_compare_pairs, _schema(COMPARED))
    return compared.filter(F.col("end").isNull()).select(*COMPARED).unionByName(bordering)
