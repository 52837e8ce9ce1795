"""CSV and JSON files."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from paperloom.functions.articles import DISPLAY_NAMES, parse_list_literal
from paperloom.sinks.writers import CSV_OPTIONS

SURPLUS_COLUMN = "timestamp_epoch"


def read_csv(spark: SparkSession, path: str) -> DataFrame:
    """All columns as string, named by the header. Quoted fields may hold doubled
    quotes and line breaks; a file with line breaks in fields is one task, so keep
    files of a bounded size (``write_csv`` does). Files of a folder may have different headers:
    those with the same one are read together, and a column that a file lacks is NULL there."""
    reader = spark.read.options(**CSV_OPTIONS, multiLine="true", enforceSchema="false")
    groups = files_by_header(spark, path)
    if len(groups) < 2:
        return reader.csv(path)
    parts = [reader.csv(files) for files in groups.values()]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)


def files_by_header(spark: SparkSession, path: str) -> dict[str, list[str]]:
    """The files of a folder by their first line, headers in order of the alphabet. Only the beginning
    of each file is looked at; the driver has the names of the files, as it has for any scan."""
    lines = spark.read.text(path).select(
        "value", "_metadata.file_path", "_metadata.file_block_start", F.monotonically_increasing_id().alias("at")
    )
    firsts = lines.filter(F.col("file_block_start") == 0).groupBy("file_path").agg(F.min_by("value", "at").alias("header"))
    found: dict[str, list[str]] = {}
    for row in firsts.orderBy("header", "file_path").collect():
        found.setdefault(row["header"], []).append(row["file_path"])
    return found


def read_csv_parts(spark: SparkSession, path: str) -> DataFrame:
    """What ``write_csv_parts`` wrote: the rows of its parts, named by its header."""
    header = spark.read.options(**CSV_OPTIONS).csv(f"{path}/header").schema
    options = {**CSV_OPTIONS, "header": "false", "multiLine": "true"}
    return spark.read.options(**options).schema(header).csv(f"{path}/parts")


def drop_surplus(df: DataFrame) -> DataFrame:
    return df.drop(SURPLUS_COLUMN)


def typed_articles(df: DataFrame) -> DataFrame:
    """Exported text columns as typed article columns. Ids that are no number fail the
    job; an absent country is the empty string. Files of other writers have empty fields where
    a value is missing."""

    def text(name: str) -> Column:
        return F.col(f"`{DISPLAY_NAMES[name]}`")

    def given(name: str) -> Column:
        return F.nullif(text(name), F.lit(""))

    return df.select(
        given("article_id").cast("bigint").alias("article_id"),
        text("title").alias("title"),
        text("abstract").alias("abstract"),
        parse_list_literal(given("author_names")).alias("author_names"),
        F.coalesce(text("country"), F.lit("")).alias("country"),
        given("publish_date").cast("date").alias("publish_date"),
        parse_list_literal(given("keywords")).alias("keywords"),
    )


def unreadable_lists(df: DataFrame) -> DataFrame:
    """The rows whose list columns hold text that is no list."""
    bad = F.lit(False)
    for name in ("author_names", "keywords"):
        text = F.nullif(F.col(f"`{DISPLAY_NAMES[name]}`"), F.lit(""))
        bad = bad | (text.isNotNull() & parse_list_literal(text).isNull())
    return df.filter(bad)


def read_article_files(spark: SparkSession, path: str, one_per_file: bool = True) -> DataFrame:
    """Raw article JSON as column ``raw``: whole files, or one article per line.

    Line files split freely and suit bulk data; Spark packs small whole files into
    shared tasks.
    """
    lines = spark.read.option("recursiveFileLookup", "true").text(path, wholetext=one_per_file)
    return lines.select(F.col("value").alias("raw")).filter(F.trim("raw") != "")
