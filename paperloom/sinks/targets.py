"""The table articles are loaded into: a catalog table in buckets or a JDBC table."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paperloom.functions.articles import ARTICLE_SCHEMA
from paperloom.sinks import tables
from paperloom.sinks.tables import BucketTable, TablePlace
from paperloom.sources.jdbc import read_options, read_table


class TableTarget(BucketTable):
    """A table in buckets of the article id: a merge shuffles the batch and reads the target in
    place, whatever its size."""

    def __init__(
        self, spark: SparkSession, place: TablePlace, schema: T.StructType = ARTICLE_SCHEMA, key: str = "article_id"
    ):
        super().__init__(spark, place, schema, key)

    def holding(self, batch: DataFrame) -> DataFrame:
        """The rows that may have the keys of ``batch``."""
        return self.read()

    def overwrite(self, df: DataFrame, expected: int = 0) -> None:
        """``expected`` is about how many bytes come, if that is known."""
        self.create().make_room(expected)
        self.insert(df, overwrite=True)
        self.grow()

    def append(self, df: DataFrame, expected: int = 0) -> None:
        self.make_room(expected)
        self.insert(df)
        self.grow()

    def append_new(self, df: DataFrame, expected: int = 0) -> None:
        """``append`` of rows whose keys the table lacks. Many go in turns: should one of them fail, the
        same load brings what is left."""
        self.make_room(expected)
        if expected > tables.TURN_BYTES:
            self.insert_in_turns(df)
        else:
            self.insert(df)
        self.grow()


class JdbcTarget:
    def __init__(
        self,
        spark: SparkSession,
        url: str,
        table: str,
        properties: dict[str, str] | None = None,
        key: str | None = "article_id",
        partitions: int = 16,
        batch_size: int = 5000,
    ):
        self.spark = spark
        self.options = read_options(url, table, properties)
        self.key = key
        self.partitions = partitions
        self.batch_size = batch_size

    def write_options(self) -> dict[str, str]:
        """``numPartitions`` bounds the open connections."""
        return {**self.options, "numPartitions": str(self.partitions), "batchsize": str(self.batch_size)}

    def read(self) -> DataFrame:
        return read_table(self.spark, self.options, self.key, self.partitions)

    def holding(self, batch: DataFrame) -> DataFrame:
        """The rows in the key range of ``batch``; the range is sent to the database."""
        low, high = batch.agg(F.min(self.key), F.max(self.key)).first()
        found = self.read()
        return found.filter(F.col(self.key).between(low, high)) if low is not None else found.limit(0)

    def overwrite(self, df: DataFrame, expected: int = 0) -> None:
        """Replace the rows; the table, its keys and its indexes stay."""
        options = {**self.write_options(), "truncate": "true"}
        df.write.format("jdbc").options(**options).mode("overwrite").save()

    def append(self, df: DataFrame, expected: int = 0) -> None:
        df.write.format("jdbc").options(**self.write_options()).mode("append").save()

    append_new = append
