"""SimHash near-dedup with pigeonring filtering.

A fingerprint has 64 bits, cut into a ring of segments. If two fingerprints differ in at most
``max_bits`` bits, some segment starts a chain that stays within its share: for every length
l, the first l segments from there differ in at most l * max_bits / segments bits. While that
share is below one, the chain must be equal, so it serves as the key of a bucket; the longer
chains prune the pairs of a bucket before the full distance is taken.

Equal fingerprints are one row before any bucket is built. A bucket with more than
``BUCKET_ROWS`` fingerprints is not compared pair by pair: there, every fingerprint is filed
under all values that lie within half the distance, and those that meet at a value are tied to
the smallest of them. At 2 bits this finds the same components as all pairs, and a value gathers at
most 1 + the number of free bits.

Defined cases: a null or empty text has fingerprint zero and links like any other; a text of
fewer than ``shingle`` words is one shingle; copies and identical rows share a component;
a null doc_id is never a component_id unless all ids of the component are null; an empty
table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import components, drop_rows, numbered
from paperloom.session import stage_table

SHINGLE = 3
MAX_BITS = 2
SEGMENTS = 7
BUCKET_ROWS = 64
SEED = 42
BLOCK = 1 << 15
ROWS_AT_ONCE = 256


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """A bit is set if more than half the shingle hashes have it. bytes.lower and bytes.split
    know ASCII only, which is what the word definition asks for."""
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    if len(words) < shingle:
        shingles, total = iter([b" ".join(words)]), 1
    else:
        shingles = map(b" ".join, zip(*[words[i:] for i in range(shingle)]))
        total = len(words) - shingle + 1
    counts, digest, left = np.zeros(64, np.int64), xxhash.xxh64_intdigest, total
    while left:
        size = min(BLOCK, left)
        hashes = np.fromiter((digest(next(shingles), SEED) for _ in range(size)), "<u8", size)
        counts += _bit_counts(hashes)
        left -= size
    return int(np.packbits(counts * 2 > total, bitorder="little").view("<u8")[0])


def _bit_counts(hashes: np.ndarray) -> np.ndarray:
    """How many of the hashes have each bit."""
    bits = np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    # Sums of up to 255 rows stay in a byte, which halves the time.
    whole = len(bits) // 255 * 255
    counts = bits[:whole].reshape(-1, 255, 64).sum(axis=1, dtype=np.uint8).sum(axis=0, dtype=np.int64)
    return counts + bits[whole:].sum(axis=0, dtype=np.int64)


def _text_key() -> Column:
    return F.xxhash64("text")


def fingerprints(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """(doc_id, text_key, fp) of every row, whole texts; ``fp`` holds the 64 bits as a long,
    ``text_key`` is a hash of the text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for start in range(0, batch.num_rows, ROWS_AT_ONCE):
                part = batch.slice(start, ROWS_AT_ONCE)
                fps = np.array([fingerprint(t.as_py(), shingle) for t in part.column(2)], np.uint64)
                columns = [part.column(0), part.column(1), pa.array(fps.view(np.int64))]
                yield pa.record_batch(columns, ["doc_id", "text_key", "fp"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), _text_key().alias("text_key"), "text")
    return rows.mapInArrow(run, "doc_id long, text_key long, fp long")


# --- the ring -------------------------------------------------------------------------


def ring(segments: int, max_bits: int) -> tuple[list[int], int]:
    """(mask of each segment, how many segments of a chain must be equal)."""
    cuts = [64 * i // segments for i in range(segments + 1)]
    masks = [((1 << (b - a)) - 1) << a for a, b in zip(cuts, cuts[1:])]
    return masks, -(-segments // max_bits) - 1


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _chain_mask(masks: list[int], start: int, length: int) -> int:
    return sum(masks[(start + i) % len(masks)] for i in range(length))


def _entries(fps: DataFrame, masks: list[int], equal: int) -> DataFrame:
    """One row per fingerprint and start of a chain, with the bits that must be equal."""
    chains = [
        F.struct(F.lit(i).alias("chain"), F.col("fp").bitwiseAND(F.lit(_signed(_chain_mask(masks, i, equal)))).alias("bits"))
        for i in range(len(masks))
    ]
    return fps.select("fp", F.inline(F.array(*chains)))


def _within_shares(a: Column, b: Column, masks: list[int], equal: int, max_bits: int) -> Column:
    """The chain from the bucket's start stays within its share at every further length."""
    different = a.bitwiseXOR(b)

    def chain(start: int) -> Column:
        kept = F.lit(True)
        for length in range(equal + 1, len(masks) + 1):
            bits = F.bit_count(different.bitwiseAND(F.lit(_signed(_chain_mask(masks, start, length)))))
            kept = kept & (bits <= length * max_bits // len(masks))
        return kept

    choice = chain(0)
    for start in range(1, len(masks)):
        choice = F.when(F.col("chain") == start, chain(start)).otherwise(choice)
    return choice


def _meeting_points(crowded: DataFrame, masks: list[int], equal: int) -> DataFrame:
    """Links inside crowded buckets: every fingerprint is filed under itself and under each
    value one free bit away, and the smallest of those that meet is linked with the others."""
    free = [
        [b for b in range(64) if not _chain_mask(masks, i, equal) >> b & 1] for i in range(len(masks))
    ]
    flips = F.array(*[F.array(F.lit(0).cast("long"), *[F.lit(_signed(1 << b)) for b in bits]) for bits in free])
    filed = crowded.select("chain", "bits", "fp", F.explode(flips[F.col("chain")]).alias("flip"))
    filed = filed.select("chain", F.col("fp").bitwiseXOR(F.col("flip")).alias("point"), "fp")
    # At most 1 + the number of free bits distinct fingerprints lie around one point.
    around = filed.groupBy("chain", "point").agg(F.collect_set("fp").alias("fps"))
    return around.filter(F.size("fps") > 1).select(F.array_min("fps").alias("a"), F.explode("fps").alias("b")).filter("a <> b")


def links(fps: DataFrame, max_bits: int = MAX_BITS, segments: int = SEGMENTS) -> DataFrame:
    """(a, b) between distinct fingerprints that tie together all at ``max_bits`` bits or less.

    ``fps`` has one row per distinct fingerprint. Buckets with one row go before anything is
    joined. The pairs of the others are pruned by the ring before the full distance is taken.
    """
    if max_bits != 2:
        raise ValueError("the meeting points of crowded buckets are those of 2 bits")
    masks, equal = ring(segments, max_bits)
    entries = _entries(fps, masks, equal)
    counts = entries.groupBy("chain", "bits").agg(F.count(F.lit(1)).alias("n")).filter("n > 1")
    shared = stage_table(entries.join(counts, ["chain", "bits"]), "ring")
    small = shared.filter(F.col("n") <= BUCKET_ROWS).select("chain", "bits", "fp")
    other = small.select("chain", "bits", F.col("fp").alias("b"))
    a, b = F.col("fp"), F.col("b")
    pairs = (
        small.join(other, ["chain", "bits"])
        .filter((a < b) & _within_shares(a, b, masks, equal, max_bits))
        .filter(F.bit_count(a.bitwiseXOR(b)) <= max_bits)
    )
    crowded = shared.filter(F.col("n") > BUCKET_ROWS).select("chain", "bits", "fp")
    points = _meeting_points(crowded, masks, equal)
    return pairs.select(F.col("fp").alias("a"), "b").unionByName(points).distinct()


def decide(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """Every row of ``docs``: doc_id, text_key, fp, component_id, the winner of its component,
    and whether it is that one. Written table."""
    rows = numbered(fingerprints(docs, shingle), "fingerprints")
    same = rows.groupBy("fp", "doc_id", "text_key").agg(
        F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("same")
    )
    null_id = F.col("doc_id").isNull().alias("null_id")
    first = F.min(F.struct(null_id, "doc_id", "text_key", "row_id", "same")).alias("w")
    distinct = stage_table(same.groupBy("fp").agg(first), "distinct-fingerprints")
    roots = components(links(distinct.select("fp"), max_bits)).withColumnRenamed("node", "fp")
    linked = distinct.join(roots, "fp", "left").select("fp", "w", F.coalesce("root", "fp").alias("root"))
    winners = linked.groupBy("root").agg(F.min("w").alias("winner"))
    classes = stage_table(linked.join(winners, "root").select("fp", "winner"), "fingerprint-classes")
    kept = (F.col("row_id") == F.col("winner.row_id")).alias("kept")
    component = F.col("winner.doc_id").alias("component_id")
    decided = rows.join(classes, "fp").select("doc_id", "text_key", "fp", component, "winner", kept)
    return stage_table(decided, "near-decisions")


def dedup(docs: DataFrame, shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """``docs`` with one row of each component, all its columns."""
    decided = decide(docs, shingle, max_bits)
    key = ["doc_id", "text_key"]
    twin = F.col("doc_id").eqNullSafe(F.col("winner.doc_id")) & (F.col("text_key") == F.col("winner.text_key"))
    dropped = stage_table(decided.filter(~F.col("kept") & ~twin).select(key).distinct(), "dropped")
    repeated = stage_table(decided.filter(F.col("kept") & (F.col("winner.same") > 1)).select(key), "repeated")
    return drop_rows(docs, [F.col("doc_id"), _text_key()], dropped, repeated)
