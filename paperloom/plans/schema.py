"""Tables of the normalised pair."""

from __future__ import annotations

from pyspark.sql import SparkSession

# Table and column names. Ids are BIGINT because source ids need more
# than 32 bits.
TABLES = {
    "Article": "id BIGINT NOT NULL, title STRING, abstract STRING, publishdate DATE",
    "ArticleKeywords": "id BIGINT NOT NULL, article_id BIGINT, keyword STRING",
}

# The journal of the loads: what is prepared and not done was interrupted.
LOADS = "ArticleLoads"
LOADS_SCHEMA = "load STRING, place STRING, state STRING"
PREPARED, DONE = "prepared", "done"


def create_schema(spark: SparkSession, database: str = "default", location: str | None = None) -> list[str]:
    """Create both tables, and the journal, where absent; returns the names of the two."""
    names = []
    for table, columns in {**TABLES, LOADS: LOADS_SCHEMA}.items():
        name = f"{database}.{table}"
        place = f" LOCATION '{location}/{table}'" if location else ""
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet{place}")
        names.append(name)
    return names[: len(TABLES)]
