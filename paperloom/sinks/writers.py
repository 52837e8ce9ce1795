"""CSV export, run files, raw landing, JDBC writes and previews."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window, functions as F, types as T

from paperloom.functions.articles import list_to_text

ROWS_PER_FILE = 100_000

# Of Parquet files that stay: a third less than Spark's default on texts.
COMPRESSION = "zstd"

# How both sides spell a field, so that what is written comes back: outer spaces stay, and NULL
# differs from the empty string.
CSV_OPTIONS = {
    "header": "true",
    "quote": '"',
    "escape": '"',
    "nullValue": "\\N",
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}


def _as_text(df: DataFrame) -> DataFrame:
    columns = [
        list_to_text(F.col(f"`{f.name}`")).alias(f.name)
        if isinstance(f.dataType, T.ArrayType)
        else F.col(f"`{f.name}`")
        for f in df.schema
    ]
    return df.select(*columns)


def write_csv(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE, compression: str | None = None) -> None:
    """Replace ``path`` by header CSV files, written in parallel and of bounded size.
    Lists become JSON arrays, which ``parse_list_literal`` reads back."""
    writer = _as_text(df).write.mode("overwrite")
    if compression:
        writer = writer.option("compression", compression)
    writer.options(**CSV_OPTIONS, maxRecordsPerFile=str(rows_per_file)).csv(path)


def write_csv_parts(df: DataFrame, path: str, rows_per_file: int = ROWS_PER_FILE) -> DataFrame:
    """Replace ``path`` by one CSV file in parts, written in parallel: ``header``, ``parts`` without
    a header of their own, and a ``manifest`` (position, path, bytes, offset), which is returned.
    The files put one after the other in the order of the manifest are the whole file, byte by byte."""
    spark, text = df.sparkSession, _as_text(df)
    options = {**CSV_OPTIONS, "maxRecordsPerFile": str(rows_per_file)}
    names = spark.createDataFrame([tuple(text.columns)], ", ".join(f"c{i} string" for i in range(len(text.columns))))
    names.coalesce(1).write.mode("overwrite").options(**{**options, "header": "false"}).csv(f"{path}/header")
    text.write.mode("overwrite").options(**{**options, "header": "false"}).csv(f"{path}/parts")
    files = spark.read.format("binaryFile").load([f"{path}/header", f"{path}/parts"]).select("path", "length")
    name = F.substring_index("path", "/", -1)
    in_order = Window.orderBy(~F.col("path").contains("/header/"), name)  # a row per file
    manifest = files.select(
        (F.row_number().over(in_order) - 1).alias("position"),
        "path",
        F.col("length").alias("bytes"),
        (F.sum("length").over(in_order) - F.col("length")).alias("offset"),
    )
    manifest.coalesce(1).write.mode("overwrite").json(f"{path}/manifest")
    return spark.read.schema(manifest.schema).json(f"{path}/manifest")


def write_run(articles: DataFrame, path: str, run_id: str) -> None:
    """The articles of one harvest run under their own folder; a repeated run replaces
    only itself."""
    articles.write.mode("overwrite").parquet(f"{path}/run_id={run_id}", compression=COMPRESSION)


def land_raw(raw: DataFrame, path: str, by: str = "year") -> None:
    """Raw article JSON as a table partitioned by ``by``."""
    raw.write.mode("overwrite").partitionBy(by).parquet(path)


def land_lines(raw: DataFrame, path: str, json_col: str = "raw") -> None:
    """Raw article JSON as text, one article per line; line breaks between tokens are
    the only ones JSON may hold, so they can be dropped."""
    raw.select(F.regexp_replace(json_col, r"[\r\n]+", " ").alias("value")).write.mode("overwrite").text(path)


def preview(df: DataFrame, rows: int = 20) -> None:
    df.show(rows)
