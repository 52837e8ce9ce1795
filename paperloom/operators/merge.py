"""Bringing a batch together with what a target already holds."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from paperloom.operators import dedupe
from paperloom.session import stage_table


def null_keys(batch: DataFrame, key: str) -> DataFrame:
    """The rows no load can take: their key is NULL, so no later load would know them again."""
    return batch.filter(F.col(key).isNull())


def new_rows(batch: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """The batch rows whose key the target lacks; rows without a key are left to ``null_keys``.

    The target's keys are made distinct in its tasks, so a repeated key is no hot join key,
    and Spark's size check decides whether the smaller side is broadcast.
    """
    keyed = batch.filter(F.col(key).isNotNull())
    known = target.select(key).filter(F.col(key).isNotNull()).distinct()
    return keyed.join(known, key, "left_anti")


def fresh_rows(landed: DataFrame, target: DataFrame, key: str) -> DataFrame:
    """``new_rows`` of a table with wide rows: only its keys meet the target. The rows stay in their tasks
    if few keys are known, or few are new."""
    keyed = landed.filter(F.col(key).isNotNull())
    own = keyed.select(key).distinct()
    known = stage_table(own.join(target.select(key), key, "left_semi"), "known-keys")
    held = known.count()
    if held == 0:
        return keyed
    if held > dedupe.KEYS_SENT:
        fresh = stage_table(own.join(known, key, "left_anti"), "fresh-keys")
        if fresh.count() <= dedupe.KEYS_SENT:
            return dedupe.with_keys(keyed, key, fresh, "left_semi")
    return dedupe.with_keys(keyed, key, known, "left_anti")


def union_distinct(left: DataFrame, right: DataFrame) -> DataFrame:
    """Both inputs by column name, each distinct row once."""
    return left.unionByName(right).distinct()
