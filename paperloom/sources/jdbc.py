"""Partitioned JDBC reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F


def read_options(url: str, table: str, properties: dict[str, str] | None = None) -> dict[str, str]:
    """Reader options. Credentials come from the caller or the environment, never from
    this package."""
    return {"url": url, "dbtable": table, **(properties or {})}


def range_options(column: str, lower: int, upper: int, partitions: int) -> dict[str, str]:
    """One query per id range. Bounds only shape the ranges; rows outside them are
    read too."""
    return {
        "partitionColumn": column,
        "lowerBound": str(lower),
        "upperBound": str(upper),
        "numPartitions": str(max(1, partitions)),
    }


def key_bounds(spark: SparkSession, options: dict[str, str], key: str) -> tuple[int, int] | None:
    """Smallest and largest key, computed by the database: one row."""
    query = f"(SELECT MIN({key}) AS lo, MAX({key}) AS hi FROM {options['dbtable']}) bounds"
    row = spark.read.format("jdbc").options(**{**options, "dbtable": query}).load().first()
    return None if row is None or row[0] is None else (int(row[0]), int(row[1]))


def range_predicates(column: str, cuts: list[int]) -> list[str]:
    """One condition per range between ``cuts``, open at both ends; a row meets exactly one, a row
    without a key the first."""
    edges = sorted(set(cuts))
    if not edges:
        return ["1 = 1"]
    between = [f"{column} >= {a} AND {column} < {b}" for a, b in zip(edges, edges[1:])]
    return [f"{column} < {edges[0]} OR {column} IS NULL", *between, f"{column} >= {edges[-1]}"]


def balanced_cuts(keys: DataFrame, column: str, partitions: int) -> list[int]:
    """Where to cut the keys for ranges of about as many rows each, however they are spread: at most
    ``partitions - 1`` numbers come to the driver."""
    shares = [i / partitions for i in range(1, partitions)]
    error = 0.1 / partitions
    found = keys.select(F.percentile_approx(column, shares, int(1 / error)).alias("cuts")).first()["cuts"] if shares else None
    return sorted({int(cut) for cut in found or []})


def read_table(
    spark: SparkSession,
    options: dict[str, str],
    key: str | None = "article_id",
    partitions: int = 64,
    balanced: bool = False,
) -> DataFrame:
    """A table in ``partitions`` parallel key ranges; Spark sends column choice and
    filters along to the database. Ranges are even steps between the least and the largest key, or,
    ``balanced``, hold about as many rows each, for which the keys alone are read first.
    ``key=None`` reads in one piece, for tables without a numeric key."""
    bounds = key_bounds(spark, options, key) if key else None
    ranges = range_options(key, *bounds, partitions) if key and bounds else {}
    even = spark.read.format("jdbc").options(**options, **ranges).load()
    if not (balanced and ranges):
        return even
    predicates = range_predicates(key, balanced_cuts(even.select(key), key, partitions))
    properties = {k: v for k, v in options.items() if k not in ("url", "dbtable")}
    return spark.read.jdbc(options["url"], options["dbtable"], predicates=predicates, properties=properties)
