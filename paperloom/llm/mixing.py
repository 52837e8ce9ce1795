"""Mixing sources to target weights.

The share p of a source's tokens becomes the weight p ** alpha / sum(p ** alpha). alpha is
found by bisection between 0 (all sources alike) and 1 (as they are): the largest exponent at
which the weights are even enough, raised if a source would then be repeated too often. A
weight becomes a token budget, and a budget whole blocks and a part of one: each block is a
permutation of the source's documents by a hash of block and doc_id, the last one is cut where
the budget ends.

Nothing but one row per pass comes to the driver: a pass takes four steps of the bisection by
evaluating all 15 exponents that they can reach. The cut of a last block is found by narrowing
a range of the hash, so a source with any share of the rows is summed in many tasks; then each
document compares its own hash with the cut of its source.

Defined cases: a null source is a source of its own; a document without words counts as one
token; a null doc_id hashes as the text ``null``; rows with equal doc_id share their places;
an empty table gives an empty result; other columns are kept and may have any name.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window, functions as F

from paperloom.llm.common import whole_text
from paperloom.session import stage_table

STEPS_PER_PASS = 4
PASSES = 9
PLACE_BITS = 60
LEVEL_BITS = 12
LEVELS = 3
DIGITS = 9


def word_count() -> Column:
    words = F.regexp_count(whole_text(), F.lit(r"[^\x20\x09-\x0D]+"))
    return F.greatest(words, F.lit(1)).cast("long")


def place(block: Column) -> Column:
    """Place of a document in a block: 60 bits of a hash of the two."""
    doc = F.coalesce(F.col("doc_id").cast("string"), F.lit("null"))
    digest = F.md5(F.concat_ws("|", block.cast("string"), doc))
    return F.conv(F.substring(digest, 1, PLACE_BITS // 4), 16, 10).cast("long")


def _spread(shares: DataFrame, exponents: list[float]) -> list[tuple[float, float, float, float]]:
    """For each exponent (sum of p ** alpha, entropy of the weights, largest and smallest
    p ** (alpha - 1)): one row of sums over all sources."""
    columns, log_p = [], F.ln("p")
    for i, alpha in enumerate(exponents):
        power = F.exp(alpha * log_p)
        ratio = F.exp((alpha - 1.0) * log_p)
        columns += [
            F.sum(power).alias(f"z{i}"),
            F.sum(power * alpha * log_p).alias(f"e{i}"),
            F.max(ratio).alias(f"h{i}"),
            F.min(ratio).alias(f"l{i}"),
        ]
    row = shares.agg(*columns).first()
    found = []
    for i in range(len(exponents)):
        z = row[f"z{i}"]
        found.append((z, math.log(z) - row[f"e{i}"] / z, row[f"h{i}"], row[f"l{i}"]))
    return found


def _bisect(shares: DataFrame, holds) -> tuple[float, float]:
    """The two ends of the last interval around the exponent up to which ``holds`` is true."""
    at_0, at_1 = (holds(*x) for x in _spread(shares, [0.0, 1.0]))
    if at_1 or not at_0:
        return (1.0, 1.0) if at_1 else (0.0, 0.0)
    low, width = 0.0, 1.0
    for _ in range(PASSES):
        width /= 1 << STEPS_PER_PASS
        points = [low + width * i for i in range(1, 1 << STEPS_PER_PASS)]
        flags = [holds(*x) for x in _spread(shares, points)] + [False]
        low += width * flags.index(False)
    return low, low + width


def solve_exponent(
    shares: DataFrame, evenness: float | None, max_repeats: float | None, budget_share: float | None
) -> float:
    """The exponent for ``shares`` (p per source).

    ``evenness`` is the least entropy of the weights as a part of the largest possible one.
    ``budget_share`` is the budget as a part of all tokens; None stands for the smallest
    budget that takes every document once.
    """
    n = shares.count()
    alpha = 1.0
    if evenness is not None:
        target = evenness * math.log(n)
        alpha = _bisect(shares, lambda z, entropy, high, low: entropy >= target)[0]
    if max_repeats is not None:

        def too_often(z: float, entropy: float, high: float, low: float) -> bool:
            return high / low > max_repeats if budget_share is None else high / z * budget_share > max_repeats

        alpha = max(alpha, _bisect(shares, too_often)[1])
    return round(alpha, DIGITS)


def _running_cell(cells: DataFrame) -> DataFrame:
    """The first cell of each source at which the running tokens pass its rest."""
    order = Window.partitionBy("source").orderBy("cell")
    running = cells.withColumn("upto", F.sum("tokens").over(order)).filter("upto > rest")
    left = (F.col("rest") - F.col("upto") + F.col("tokens")).alias("rest")
    first = running.groupBy("source").agg(F.min(F.struct("cell", left)).alias("first"))
    return first.select("source", "first.cell", "first.rest")


def _cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """(source, cut): the place at which the last block of a source ends. ``rows`` has source,
    doc_id, tokens."""
    partial = plan.filter("rest > 0").select("source", "blocks", "rest")
    joined = _with_source(rows, partial)
    placed = stage_table(joined.select("source", "rest", "tokens", place(F.col("blocks")).alias("place")), "places")
    open_ = placed
    for level in range(1, LEVELS + 2):
        shift = PLACE_BITS - LEVEL_BITS * level if level <= LEVELS else 0
        cell = F.shiftright("place", shift).alias("cell")
        cells = open_.groupBy("source", cell).agg(F.sum("tokens").alias("tokens"), F.first("rest").alias("rest"))
        found = stage_table(_running_cell(cells), "cells")
        if level <= LEVELS:
            inside = _with_source(placed.drop("rest"), found)
            open_ = inside.filter(F.shiftright("place", shift) == F.col("cell")).drop("cell")
    return found.select("source", F.col("cell").alias("cut"))


def _with_source(rows: DataFrame, per_source: DataFrame, kind: str = "inner") -> DataFrame:
    """Rows joined with a written table of one row per source; Spark's size check decides
    whether it is broadcast, its skew join splits a large source otherwise."""
    other = per_source.withColumnRenamed("source", "other_source")
    return rows.join(other, F.col("source").eqNullSafe(F.col("other_source")), kind).drop("other_source")


def plan_mix(
    docs: DataFrame,
    evenness: float | None = None,
    max_repeats: float | None = None,
    budget_share: float | None = None,
    tokens: Column | None = None,
) -> DataFrame:
    """One row per source: tokens, weight, repeats, blocks and the cut of the last block.
    Written table."""
    counted = docs.select("source", "doc_id", (word_count() if tokens is None else tokens).alias("tokens"))
    rows = stage_table(counted, "token-counts")
    sums = stage_table(rows.groupBy("source").agg(F.sum("tokens").alias("tokens")), "source-tokens")
    total = sums.agg(F.sum("tokens")).first()[0]
    schema = "source string, tokens long, weight double, repeats double, blocks long, cut long"
    if total is None:
        return docs.sparkSession.createDataFrame([], schema)
    shares = sums.select("source", "tokens", (F.col("tokens") / F.lit(float(total))).alias("p"))
    alpha = solve_exponent(shares, evenness, max_repeats, budget_share)
    z, _, _, low = _spread(shares, [alpha])[0]
    share = z / low if budget_share is None else budget_share
    weight = F.exp(alpha * F.ln("p")) / F.lit(z)
    repeats = F.round(weight * F.lit(share) / F.col("p"), DIGITS)
    weighted = shares.select("source", "tokens", weight.alias("weight"), repeats.alias("repeats"))
    blocks = F.floor("repeats")
    rest = F.round((F.col("repeats") - blocks) * F.col("tokens")).cast("long")
    plan = stage_table(weighted.withColumns({"blocks": blocks, "rest": rest}), "mix-plan")
    whole = _with_source(plan, _cuts(rows, plan), "left")
    ended = F.when(F.col("rest") > 0, F.coalesce("cut", F.lit(1 << PLACE_BITS))).otherwise(F.lit(0))
    columns = ["source", "tokens", "weight", "repeats", "blocks", ended.cast("long").alias("cut")]
    return stage_table(whole.select(*columns), "mix-plan")


def mix(docs: DataFrame, plan: DataFrame) -> DataFrame:
    """Every document once per block that takes it: ``row`` (all its columns), ``block`` and
    ``position`` in its source's stream from 0 to 1. Sorting by position interleaves the
    sources in their weights; no document moves for it."""
    rows = docs.select("source", "doc_id", F.struct("*").alias("row"))
    joined = _with_source(rows, plan.select("source", "repeats", "blocks", "cut"))
    times = F.col("blocks") + F.when((F.col("cut") > 0) & (place(F.col("blocks")) < F.col("cut")), 1).otherwise(0)
    taken = joined.withColumn("times", times.cast("int")).filter("times > 0")
    each = taken.select("row", "doc_id", "repeats", F.explode(F.sequence(F.lit(0), F.col("times") - 1)).alias("block"))
    along = (F.col("block") + place(F.col("block")) / F.lit(float(1 << PLACE_BITS))) / F.col("repeats")
    return each.select("row", F.col("block").cast("long").alias("block"), along.alias("position"))
