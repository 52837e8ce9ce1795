"""A corpus from raw documents to token ids, stage by stage."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession, functions as F

from paperloom.llm import bpe, exact, langid, mixing, simhash
from paperloom.llm.common import prepared
from paperloom.llm.queries import VOCABULARY
from paperloom.session import scratch_path

# The least even mix that takes every document, none more often than this.
MAX_REPEATS = 2.0


def language_id(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without letters, and those unlike any language of the corpus, go."""
    prepared(spark)
    held_out = langid.in_fold(F.col("doc_id"), 4, 2)
    models = langid.train(docs.filter(~held_out & F.col("doc_id").isNotNull()).select("doc_id", "lang", "text"))
    rows = docs.select(F.struct("*").alias("row"))
    return langid.predict(rows, models, ["row"], text="row.text").filter(~F.col("rejected")).select("row.*")


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each group of equal texts stays."""
    prepared(spark)
    return exact.dedup(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One of each component of near copies stays."""
    prepared(spark)
    return simhash.dedup(docs, shingle=3, max_bits=2)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Smaller sources gain weight by repeated blocks; every document stays at least once."""
    prepared(spark)
    plan = mixing.plan_mix(docs, evenness=1.0, max_repeats=MAX_REPEATS)
    return mixing.mix(docs, plan).select("row.*")


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document, with the digest of what they decode to."""
    prepared(spark)
    encoder = bpe.Encoder(spark, public_tokenizers.path(VOCABULARY), public_tokenizers.PATTERN)
    return bpe.round_trip(docs, encoder, ["doc_id", "lang", "source"])


STAGES = [
    ("language_id", language_id),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("mix_sources", mix_sources),
    ("encode", encode),
]

# Language models, fingerprints and token ids have no SQL; tests hold the rows against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result is written and read by the next stage."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        path = scratch_path(spark, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
