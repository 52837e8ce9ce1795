"""Catalog tables whose rows lie in buckets of a key."""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T

from paperloom.sinks.writers import COMPRESSION

# A table begins with so many buckets and gets more once they are larger than this.
LEAST_BUCKETS = 8
BUCKET_BYTES = 512 << 20
# A merge of more bytes than this goes in turns, each for some of the buckets.
TURN_BYTES = 1 << 30
TURNS = 4


@dataclass(frozen=True)
class TablePlace:
    """The name of a table and the folder under which its files lie."""

    name: str
    path: str


def buckets_for(size: int) -> int:
    """The least power of two that keeps buckets within ``BUCKET_BYTES``."""
    buckets = LEAST_BUCKETS
    while size > buckets * BUCKET_BYTES:
        buckets *= 2
    return buckets


def file_bytes(df: DataFrame) -> int:
    """Bytes of the files that ``df`` is read from, by their listing; 0 if there are none."""
    files = df.inputFiles()
    if not files:
        return 0
    sizes = df.sparkSession.read.format("binaryFile").load(files)
    return sizes.agg(F.sum("length")).first()[0] or 0


def columns_of(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)


class BucketTable:
    """A table clustered by ``key``. The number of buckets is part of the table, so a join on the
    key leaves the table where it is and shuffles the other side alone. It needs a catalog that
    outlives the session.

    ``parts`` are columns that a load is stored under, so that it can replace its own output.
    """

    def __init__(self, spark: SparkSession, place: TablePlace, schema: T.StructType, key: str, parts: str = ""):
        self.spark = spark
        self.place = place
        self.name = place.name
        self.schema = schema
        self.key = key
        self.parts = parts

    def create(self, buckets: int = LEAST_BUCKETS) -> BucketTable:
        """The table, empty where there is none yet. A rebuild that was stopped between its two
        renames is finished."""
        catalog = self.spark.catalog
        if not catalog.tableExists(self.name) and catalog.tableExists(self._grown):
            self.spark.sql(f"ALTER TABLE {self._grown} RENAME TO {self.name}")
        self._create(self.name, buckets)
        return self

    def buckets(self) -> int:
        return int(self._described()["Num Buckets"])

    def size(self) -> int:
        """Bytes of all files, from their listing."""
        self.spark.sql(f"ANALYZE TABLE {self.name} COMPUTE STATISTICS NOSCAN")
        return int(self._described()["Statistics"].split()[0])

    def read(self) -> DataFrame:
        self.spark.catalog.refreshTable(self.name)
        return self.spark.table(self.name).select(*self.schema.names)

    def insert(self, df: DataFrame, overwrite: bool = False) -> None:
        self._placed(df, self.buckets()).write.insertInto(self.name, overwrite=overwrite)

    def insert_in_turns(self, df: DataFrame, turns: int = TURNS) -> None:
        """``insert``, some of the buckets after the others: what is shuffled at a time, and lies on the disks
        beside the table, is one of ``turns`` parts of ``df``. It is read in each turn. If it stops, some
        buckets have their rows and the others have none of them."""
        bucket = F.pmod(F.hash(self.key), F.lit(self.buckets()))
        for turn in range(turns):
            self.insert(df.filter(F.pmod(bucket, F.lit(turns)) == turn))

    def replace_part(self, df: DataFrame, **part: str | int) -> None:
        """``df`` as the whole content of one part."""
        view = f"part_{uuid.uuid4().hex}"
        self._placed(df, self.buckets()).createOrReplaceTempView(view)
        spec = ", ".join(f"{name} = {value!r}" for name, value in part.items())
        df.sparkSession.sql(f"INSERT OVERWRITE TABLE {self.name} PARTITION ({spec}) SELECT * FROM {view}")
        df.sparkSession.catalog.dropTempView(view)

    def grow(self) -> None:
        """Rebuild with as many buckets as the size asks for, where that is more. Each doubling
        writes the table once, so a row is written twice on average however large the table gets."""
        wanted = buckets_for(self.size())
        if wanted > self.buckets():
            self.rebuild(wanted)

    def make_room(self, expected: int) -> None:
        """Before a load of about ``expected`` bytes: buckets for twice what the table will have, where it
        has too few, so that nothing of the load is written again soon. 0 if unknown."""
        needed = self.size() + expected
        if expected and buckets_for(needed) > self.buckets():
            self.rebuild(buckets_for(2 * needed))

    def rebuild(self, buckets: int) -> None:
        """Write the table anew with other buckets and put it in the place of the old one. Until
        then the old one stays as it is; its files are left to the caller."""
        self.spark.sql(f"DROP TABLE IF EXISTS {self._grown}")
        self._create(self._grown, buckets)
        whole = self.spark.table(self.name)
        self._placed(whole, buckets, whole.columns).write.insertInto(self._grown)
        old = f"{self.name}_{uuid.uuid4().hex}"
        self.spark.sql(f"ALTER TABLE {self.name} RENAME TO {old}")
        self.spark.sql(f"ALTER TABLE {self._grown} RENAME TO {self.name}")
        self.spark.sql(f"DROP TABLE {old}")

    @property
    def _grown(self) -> str:
        return f"{self.name}_grown"

    def _create(self, name: str, buckets: int) -> None:
        columns = columns_of(self.schema) + (f", {self.parts}" if self.parts else "")
        parts = ", ".join(part.split()[0] for part in self.parts.split(",")) if self.parts else ""
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}) USING parquet OPTIONS (compression '{COMPRESSION}')"
            + (f" PARTITIONED BY ({parts})" if parts else "")
            + f" CLUSTERED BY (`{self.key}`) SORTED BY (`{self.key}`) INTO {buckets} BUCKETS"
            + f" LOCATION '{self.place.path}/{uuid.uuid4().hex}'"
        )

    def _placed(self, df: DataFrame, buckets: int, columns: list[str] | None = None) -> DataFrame:
        """One task per bucket, more for a bucket that is large (a NULL key may have many rows)."""
        return df.select(*(columns or self.schema.names)).hint("rebalance", buckets, self.key)

    def _described(self) -> dict[str, str]:
        return {r[0]: r[1] for r in self.spark.sql(f"DESCRIBE TABLE EXTENDED {self.name}").collect()}
