"""How far the sources of a language are apart, and by which terms.

Count-level bitmaps: per (group, count) the set of terms that occur so often there, as bits over
term ids, in words of 64. Two groups' words are joined by AND and counted by popcount, which
gives how many terms have the one count here and the other there; every such cell has one
difference of shares, so a pair's divergence is the sum of cells times difference. Terms that a
group lacks are the complement of its bits. Ids go by falling frequency, so that a word
holds terms with like counts and few levels.

Texts are counted in the tasks, and only counts are shuffled. A task compares the words of one
block of terms for two tiles of groups, so memory is bounded for any number of terms and groups.

Defined cases: null text, language and source are the empty string; a group without terms
still has shares and pairs; in a language without kept terms every pair has value 0 and no term is
listed; a language with one source has no pairs; an empty table gives an empty result; other
columns are ignored. Ties are ordered by item, bytewise.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.operators.rank import ranked
from paperloom.session import stage_table

# Fixed values of the contract.
MIN_DOCS = 30
SCALE = 1_000_000_000
PRIOR = 5
TOP_TERMS = 50
TERM = re.compile(rb"[A-Za-z\x80-\xff]+")  # [^\x00-\x40\x5B-\x60\x7B-\x7F]+ over UTF-8 bytes

# Different terms that a task holds before it passes its counts on.
TERMS_AT_ONCE = 200_000
WORD = 64
# Words of one group of the comparison, and groups in a tile.
WORDS_AT_ONCE = 16
TILE = 32

COUNTED = "lang string, source string, term string, n long, docs long"


# --- counting -------------------------------------------------------------------------


def _passed_on(totals: dict) -> Iterator[pa.RecordBatch]:
    for (lang, source), (n, docs) in totals.items():
        terms = list(n)
        columns = [
            pa.array([lang] * len(terms), pa.string()),
            pa.array([source] * len(terms), pa.string()),
            pa.array(terms, pa.binary()).cast(pa.string()),
            pa.array(n.values(), pa.int64()),
            pa.array([docs[t] for t in terms], pa.int64()),
        ]
        yield pa.record_batch(columns, ["lang", "source", "term", "n", "docs"])


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    totals: dict[tuple, tuple[Counter, Counter]] = {}
    for batch in batches:
        texts = pc.cast(batch.column(2), pa.binary()).to_pylist()
        for lang, source, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts):
            terms = TERM.findall(text.lower())  # bytes: A-Z alone
            n, docs = totals.setdefault((lang, source), (Counter(), Counter()))
            n.update(terms)
            docs.update(set(terms))
        if sum(len(n) for n, _ in totals.values()) > TERMS_AT_ONCE:
            yield from _passed_on(totals)
            totals = {}
    yield from _passed_on(totals)


def count_terms(docs: DataFrame) -> DataFrame:
    """(lang, source, term, n, docs) over all whole texts."""
    counted = docs.select("lang", "source", "text").mapInArrow(_count, COUNTED)
    return counted.groupBy("lang", "source", "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, terms: Column) -> Column:
    """1 + floor(SCALE * (count + PRIOR) / (total + PRIOR * terms)), in whole numbers; null where
    there are no terms."""
    over = F.lit(SCALE).cast("decimal(10,0)") * (count + PRIOR).cast("decimal(20,0)")
    under = F.nullif((total + PRIOR * terms).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return F.call_function("div", over, under) + 1


# --- bitmaps --------------------------------------------------------------------------


def level_bitmaps(cells: DataFrame) -> DataFrame:
    """(lang, source, word, n, bits): which terms of a word have the count ``n`` in the group."""
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), (F.col("id") % WORD).cast("int"))
    return cells.groupBy("lang", "source", F.expr(f"id div {WORD}").alias("word"), "n").agg(F.bit_or(bit).alias("bits"))


def joint_cells(bits: np.ndarray, other: np.ndarray) -> np.ndarray:
    """How many terms each level of the one has in common with each of the other."""
    return np.bitwise_count(bits[:, None] & other[None, :]).astype(np.int64)


def _with_zeros(levels: pd.DataFrame, groups: pd.DataFrame, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Bits and shares of the levels of one word by group, each group's count of zero first (the
    complement of its other levels among ``size`` terms), and where each group begins."""
    numbers = groups["number"].to_numpy()
    of = np.searchsorted(numbers, levels["number"].to_numpy())
    bits = levels["bits"].to_numpy(np.int64).view(np.uint64)
    seen = np.zeros(len(numbers), np.uint64)
    np.bitwise_or.at(seen, of, bits)
    every = np.uint64((1 << size) - 1)
    owner = np.concatenate([np.arange(len(numbers)), of])
    order = np.argsort(owner, kind="stable")
    both = np.concatenate([every & ~seen, bits])[order]
    shares = np.concatenate([groups["share"].to_numpy(np.int64), levels["share"].to_numpy(np.int64)])[order]
    return both, shares, np.searchsorted(owner[order], np.arange(len(numbers)))


def _compare(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """Sums of cells times difference of shares for the pairs of two tiles in one block of words."""
    block, low, high = int(key[1]), int(key[2]), int(key[3])
    groups = rows[rows["word"] < 0].sort_values("number")
    levels = rows[rows["word"] >= 0]
    kept_terms = int(groups["terms"].iloc[0])
    one, two = groups[groups["tile"] == low], groups[groups["tile"] == high]
    total = np.zeros((len(one), len(two)), np.int64)
    by_word = dict(iter(levels.groupby("word")))
    nothing = levels.iloc[:0]
    for word in range(block * WORDS_AT_ONCE, (block + 1) * WORDS_AT_ONCE):
        size = min(WORD, kept_terms - word * WORD)
        if size <= 0:
            break
        here = by_word.get(word, nothing)
        bits, shares, starts = _with_zeros(here[here["tile"] == low], one, size)
        other = (bits, shares, starts)
        if low != high:
            other = _with_zeros(here[here["tile"] == high], two, size)
        cells = joint_cells(bits, other[0]) * np.abs(shares[:, None] - other[1][None, :])
        total += np.add.reduceat(np.add.reduceat(cells, starts, axis=0), other[2], axis=1)
    i, j = np.nonzero(np.ones_like(total)) if low != high else np.nonzero(~np.eye(len(one), dtype=bool))
    found = pd.DataFrame(
        {
            "lang": key[0],
            "source": one["source"].to_numpy()[i],
            "item": two["source"].to_numpy()[j],
            "value": total[i, j],
        }
    )
    return found if low == high else pd.concat([found, found.rename(columns={"source": "item", "item": "source"})])


def pair_values(levels: DataFrame, groups: DataFrame) -> DataFrame:
    """(lang, source, item, value) for all ordered pairs of groups of a language.

    ``levels``: lang, source, word, n, bits and what ``groups`` has of them; ``groups``: lang,
    source, number, tile, tiles, total, terms.
    """
    columns = ["lang", "source", "number", "tile", "tiles", "terms"]
    blocks = F.sequence(F.lit(0).cast("long"), F.expr(f"(terms - 1) div {WORD * WORDS_AT_ONCE}"))
    zero = share(F.lit(0).cast("long"), F.col("total"), F.col("terms"))
    # One row per group and block, so that a group is compared where it has no term, too.
    marks = groups.filter("terms > 0").select(
        *columns, F.explode(blocks).alias("block"), F.lit(-1).cast("long").alias("word"),
        F.lit(0).cast("long").alias("bits"), zero.alias("share"),
    )
    held = levels.select(
        *columns, F.expr(f"word div {WORDS_AT_ONCE}").alias("block"), "word", "bits",
        share(F.col("n"), F.col("total"), F.col("terms")).alias("share"),
    )
    partner = F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))
    dealt = marks.unionByName(held).withColumn("partner", partner)
    dealt = dealt.withColumns({"low": F.least("tile", "partner"), "high": F.greatest("tile", "partner")})
    compared = dealt.groupBy("lang", "block", "low", "high").applyInPandas(
        _compare, "lang string, source string, item string, value long"
    )
    summed = compared.groupBy("lang", "source", "item").agg(F.sum("value").alias("value"))
    without = groups.filter("terms = 0").select("lang", "source")
    other = without.select("lang", F.col("source").alias("item"))
    zeros = without.join(other, "lang").filter("source <> item").withColumn("value", F.lit(0).cast("long"))
    return summed.unionByName(zeros)


# --- the audit ------------------------------------------------------------------------


def audit(docs: DataFrame, min_docs: int = MIN_DOCS, top_terms: int = TOP_TERMS) -> DataFrame:
    """(lang, source, part, item, value, rank) of ``docs`` (lang, source, text): part ``pair`` has
    every other source of the language, part ``term`` the terms that stand out most."""
    rows = docs.select(*[F.coalesce(c, F.lit("")).alias(c) for c in ("lang", "source", "text")])
    counts = stage_table(count_terms(rows), "term-counts")
    kept = counts.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
    kept = kept.filter(F.col("docs") >= min_docs).drop("docs")
    placed = ranked(kept, [F.desc("lang_n"), F.col("term")], ("lang",), "id").withColumn("id", F.col("id") - 1)
    cells = stage_table(counts.drop("docs").join(placed, ["lang", "term"]), "cells")
    groups = stage_table(_groups(rows, cells), "source-groups")
    pairs = pair_values(level_bitmaps(cells).join(groups, ["lang", "source"]), groups)
    n, total, terms = F.col("n"), F.col("total"), F.col("terms")
    ahead = share(n, total, terms) - share(F.col("lang_n"), F.col("lang_total"), terms)
    known = cells.join(groups, ["lang", "source"])
    words = known.select("lang", "source", F.col("term").alias("item"), ahead.alias("value")).filter("value > 0")
    top = _ranked_items(words, "term").filter(F.col("rank") <= top_terms)  # cut in the tasks, before the shuffle
    return _ranked_items(pairs, "pair").unionByName(top)


def _ranked_items(items: DataFrame, part: str) -> DataFrame:
    order = Window.partitionBy("lang", "source").orderBy(F.desc("value"), "item")
    rank = F.row_number().over(order).alias("rank")
    return items.select("lang", "source", F.lit(part).alias("part"), "item", "value", rank)


def _groups(rows: DataFrame, cells: DataFrame) -> DataFrame:
    """One row per group that occurs: its number and tile in the language, its total and the
    language's, and how many terms are kept there."""
    occurring = rows.select("lang", "source").distinct()
    totals = cells.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    # Ids are dense, so the last one tells how many terms there are.
    of_lang = cells.groupBy("lang").agg(F.sum("n").alias("lang_total"), (F.max("id") + 1).alias("terms"))
    joined = occurring.join(totals, ["lang", "source"], "left").join(of_lang, "lang", "left")
    numbered = ranked(joined.fillna(0, ["total", "lang_total", "terms"]), [F.col("source")], ("lang",), "number")
    numbered = numbered.withColumn("number", F.col("number") - 1)
    tile = F.expr(f"number div {TILE}").cast("int")
    sizes = occurring.groupBy("lang").agg((F.expr(f"(count(1) - 1) div {TILE}") + 1).cast("int").alias("tiles"))
    return numbered.withColumn("tile", tile).join(sizes, "lang")
