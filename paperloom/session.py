"""Session settings and the shared scratch folder."""

from __future__ import annotations

import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

# Run-time SQL settings the plans count on; none of them depends on data size.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
}


# Drops the shuffle files of a query once it has run.
SHUFFLE_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_local_roots: dict[str, str] = {}


def tune(spark: SparkSession) -> SparkSession:
    for key, value in SQL_SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def local_session(cores: int | str = "*", memory: str = "8g") -> SparkSession:
    """A session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("paperloom")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.driver.memory", memory)
        .config("spark.sql.shuffle.partitions", "8" if cores == "*" else str(cores))
        .config("spark.sql.files.maxPartitionBytes", "4m")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="paperloom-", dir="/tmp"))
        .config("spark.sql.warehouse.dir", tempfile.mkdtemp(prefix="paperloom-wh-", dir="/tmp"))
    )
    spark = tune(builder.getOrCreate())
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for intermediate tables.

    A cluster names it in ``spark.checkpoint.dir``. Only a local session, whose
    tasks all see this machine's disk, may fall back to a temporary folder.
    """
    configured = spark.conf.get("spark.checkpoint.dir", None)
    if configured:
        return configured.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder all executors share")
    app = spark.sparkContext.applicationId
    if app not in _local_roots:
        _local_roots[app] = tempfile.mkdtemp(prefix="paperloom-", dir="/tmp")
    return _local_roots[app]


def scratch_path(spark: SparkSession, name: str) -> str:
    return f"{scratch_root(spark)}/{name}-{uuid.uuid4().hex}"


def stage_table(df: DataFrame, name: str, *partition_cols: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage with
    a table that outlives any executor."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    writer = df.write.mode("errorifexists")
    if partition_cols:
        writer = writer.partitionBy(*partition_cols)
    writer.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


@contextmanager
def shuffles_dropped(spark: SparkSession) -> Iterator[None]:
    """What runs in here keeps no shuffle files beyond its own end; else they lie on the disks until the
    driver happens to collect its garbage. For jobs that write each result once."""
    before = spark.conf.get(SHUFFLE_CLEANUP, "false")
    spark.conf.set(SHUFFLE_CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(SHUFFLE_CLEANUP, before)


_shipped_to: set[str] = set()


def ship_package(spark: SparkSession) -> SparkSession:
    """Give the Python workers this package, once per application. A cluster job that
    is submitted with the package (``--py-files``) does not need it."""
    app = spark.sparkContext.applicationId
    if app not in _shipped_to:
        package = Path(__file__).resolve().parent
        archive = Path(tempfile.mkdtemp(prefix="paperloom-pkg-", dir="/tmp")) / "paperloom.zip"
        with zipfile.ZipFile(archive, "w") as bundle:
            for source in sorted(package.rglob("*.py")):
                bundle.write(source, source.relative_to(package.parent))
        spark.sparkContext.addPyFile(str(archive))
        _shipped_to.add(app)
    return spark
