"""Exact dedup through a minimal perfect hash over the digests that are already known.

The history is a table with one row per shard of digests: the levels of the hash, and for
each slot the full digest and the locator (document and row) of the text that stays. New
texts are first grouped by digest, then each distinct digest looks up its slot and is
compared with the digest there byte by byte. Members are repeats of a historical text;
nonmembers are grouped among themselves.

Defined cases: a null text is empty; a null doc_id never wins over another one; identical
rows count as copies, one of them stays; an empty table gives an empty result; other columns
are ignored.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, functions as F

from paperloom.llm.common import drop_rows, numbered, whole_text
from paperloom.session import stage_table

SHARD_ROWS = 4096
LEAST_SHARDS = 64
GAMMA = 2.0

INDEX = "shard int, sizes array<int>, bits binary, digests binary, ids binary, nulls binary, rows binary"
FOUND = "digest binary, null_id boolean, doc_id long, row_id long, same long, n long, member boolean"
GROUP = ["digest", "null_id", "doc_id", "row_id", "same", "n"]


def text_digest(text: Column) -> Column:
    """SHA-256 of the text with every run of white space as one space.

    Runs that are a single space already are not rewritten.
    """
    one_space = F.regexp_replace(text, r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")
    return F.unhex(F.sha2(one_space, 256))


def group_texts(rows: DataFrame) -> DataFrame:
    """(digest, doc_id, row_id) to one row per digest: the winner, how many rows are identical
    to it (``same``) and how many have the digest (``n``)."""
    same = rows.groupBy("digest", "doc_id").agg(F.min("row_id").alias("row_id"), F.count(F.lit(1)).alias("same"))
    winner = F.min(F.struct(F.col("doc_id").isNull().alias("null_id"), "doc_id", "row_id", "same"))
    grouped = same.groupBy("digest").agg(winner.alias("w"), F.sum("same").alias("n"))
    return grouped.select("digest", "w.*", "n").select(*GROUP)


# --- the hash of one shard ------------------------------------------------------------


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)


def _places(words: np.ndarray, level: int, size: int) -> np.ndarray:
    """Place of each digest on a level: its four words mixed with the level."""
    x = words[:, 1] + words[:, 2] * np.uint64(2 * level + 1)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= words[:, 3] >> np.uint64(level % 32)
    x ^= x >> np.uint64(29)
    return (x % np.uint64(size)).astype(np.int64)


def build_hash(digests: np.ndarray) -> tuple[list[int], np.ndarray, np.ndarray]:
    """(level sizes, the bits of all levels in a row, slot of each digest) for distinct digests
    given as an (n, 32) byte array: a digest takes the first level where its place is its alone."""
    words, left = _words(digests), np.arange(len(digests))
    sizes, bits, place = [], [], np.empty(len(digests), np.int64)
    start = 0
    while len(left):
        level = len(sizes)
        size = max(64, int(GAMMA * len(left)))
        at = _places(words[left], level, size)
        alone = np.bincount(at, minlength=size) == 1
        placed = alone[at]
        place[left[placed]] = start + at[placed]
        sizes.append(size)
        bits.append(alone)
        left = left[~placed]
        start += size
    bits = np.concatenate(bits) if bits else np.zeros(0, bool)
    return sizes, bits, (np.cumsum(bits) - 1)[place] if len(digests) else place


def find_slots(digests: np.ndarray, sizes: list[int], bits: np.ndarray) -> np.ndarray:
    """Slot of each digest, -1 if no level has its place. A digest that is not in the hash may
    get a slot too, hence the byte check."""
    words, left = _words(digests), np.arange(len(digests))
    slots, rank, start = np.full(len(digests), -1, np.int64), np.cumsum(bits) - 1, 0
    for level, size in enumerate(sizes):
        at = start + _places(words[left], level, size)
        hit = bits[at]
        slots[left[hit]] = rank[at[hit]]
        left = left[~hit]
        start += size
    return slots


def _matrix(digests: pd.Series) -> np.ndarray:
    return np.frombuffer(b"".join(digests), np.uint8).reshape(-1, 32)


def _build_shard(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    digests = _matrix(rows["digest"])
    sizes, bits, slots = build_hash(digests)
    order = np.argsort(slots)
    ids = rows["doc_id"].fillna(0).to_numpy(np.int64)
    shard = {
        "shard": key[0],
        "sizes": sizes,
        "bits": np.packbits(bits).tobytes(),
        "digests": digests[order].tobytes(),
        "ids": ids[order].tobytes(),
        "nulls": rows["null_id"].to_numpy(np.uint8)[order].tobytes(),
        "rows": rows["row_id"].to_numpy(np.int64)[order].tobytes(),
    }
    return pd.DataFrame([shard])


def _look_up_shard(fresh: pd.DataFrame, index: pd.DataFrame) -> pd.DataFrame:
    """Fresh groups, with the historical winner where the digest is known."""
    out = fresh[GROUP].copy()
    out["member"] = False
    out["doc_id"] = out["doc_id"].astype("Int64")
    if len(fresh) and len(index):
        shard, digests = index.iloc[0], _matrix(fresh["digest"])
        sizes = [int(n) for n in shard["sizes"]]
        bits = np.unpackbits(np.frombuffer(shard["bits"], np.uint8), count=sum(sizes)).astype(bool)
        slots = find_slots(digests, sizes, bits)
        stored = np.frombuffer(shard["digests"], np.uint8).reshape(-1, 32)
        known = slots >= 0
        known[known] = (stored[slots[known]] == digests[known]).all(axis=1)
        slot = slots[known]
        nulls = np.frombuffer(shard["nulls"], np.uint8).astype(bool)[slot]
        ids = pd.array(np.frombuffer(shard["ids"], np.int64)[slot], dtype="Int64")
        ids[nulls] = pd.NA
        where = out.index[known]
        out.loc[where, "member"] = True
        out.loc[where, "doc_id"] = pd.Series(ids, index=where)
        out.loc[where, "null_id"] = nulls
        out.loc[where, "row_id"] = np.frombuffer(shard["rows"], np.int64)[slot]
    return out


def _shard(shards: int) -> Column:
    return F.pmod(F.xxhash64("digest"), F.lit(shards)).cast("int").alias("shard")


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """The history as a written table, one row per shard of about ``SHARD_ROWS`` digests."""
    sharded = groups.select(_shard(shards), *GROUP)
    return stage_table(sharded.groupBy("shard").applyInPandas(_build_shard, INDEX), "digest-index")


def look_up(groups: DataFrame, index: DataFrame, shards: int) -> DataFrame:
    """Each fresh group with ``member`` and, for members, the historical winner. Only distinct
    digests are looked up, so a text with a third of all rows is one row here."""
    fresh = groups.select(_shard(shards), *GROUP).groupBy("shard")
    return fresh.cogroup(index.groupBy("shard")).applyInPandas(_look_up_shard, FOUND)


def decide(docs: DataFrame) -> DataFrame:
    """Every row of ``docs`` (row_id, doc_id, digest) with its winner: keep_id, group_size,
    kept, same. Written table.

    The older half by doc_id is the history; its distinct digests go into the hash, and the
    rest is looked up in it. Every row is in one of the halves.
    """
    rows = numbered(docs.select("doc_id", text_digest(whole_text()).alias("digest")), "digests")
    middle = rows.agg(F.percentile_approx("doc_id", 0.5).alias("m")).first()["m"]
    older = F.coalesce(F.col("doc_id") <= F.lit(middle), F.lit(False))
    history = stage_table(group_texts(rows.filter(older)), "history")
    shards = max(LEAST_SHARDS, -(-history.count() // SHARD_ROWS))
    found = look_up(group_texts(rows.filter(~older)), build_index(history, shards), shards)
    known = history.withColumn("member", F.lit(False)).unionByName(found)
    # The historical row and the repeats of it found later: sizes add up, the winner is the same.
    # ``same`` holds for the row that is no member.
    winners = known.groupBy("digest").agg(
        F.min_by(F.struct("doc_id", "row_id", "same"), F.col("member")).alias("w"), F.sum("n").alias("group_size")
    )
    # Two plain tables, so that Spark's skew join can split a text with many copies.
    joined = rows.join(stage_table(winners, "winners"), "digest")
    decided = joined.select(
        "row_id",
        "doc_id",
        "digest",
        F.col("w.doc_id").alias("keep_id"),
        "group_size",
        (F.col("row_id") == F.col("w.row_id")).alias("kept"),
        F.col("w.same").alias("same"),
    )
    return stage_table(decided, "exact-decisions")


def dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with one row of each group of equal texts, all its columns."""
    decided = decide(docs)
    # Rows identical to a winner share its key; they are told apart by ``repeated`` alone.
    twin = F.col("doc_id").eqNullSafe(F.col("keep_id"))
    dropped = stage_table(decided.filter(~F.col("kept") & ~twin).select("doc_id", "digest").distinct(), "dropped")
    repeated = stage_table(
        decided.filter(F.col("kept") & (F.col("same") > 1)).select("doc_id", "digest"), "repeated"
    )
    return drop_rows(docs, [F.col("doc_id"), text_digest(whole_text())], dropped, repeated)
