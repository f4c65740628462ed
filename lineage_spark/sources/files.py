"""File sources and sinks: listing, multi-part load, format dispatch, delimited
load, path table, guarded materialization."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lineage_spark.functions.text import basename

# Format precedence of a dataset's file list, first hit wins.
# parquet: any .parquet file; csv: exactly one file in all, and it is .csv; abc: any
# name ending in "abc"; rds: any .rds; h5: any .h5; otherwise the file paths as a table.
FORMATS = ("parquet", "csv", "abc", "rds", "h5", "paths")


def list_files(spark: SparkSession, path: str, pattern: str | None = None) -> DataFrame:
    """``(path, name, length)`` of the files below ``path``.

    Uses the ``binaryFile`` source with only metadata columns selected, so the
    file contents are never read.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if pattern:
        reader = reader.option("pathGlobFilter", pattern)
    return reader.load(path).select("path", basename(F.col("path")).alias("name"), "length")


def load_parts(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All non-empty ``.parquet`` parts below ``path``, appended by column name.

    The reader lists the folder itself, in parallel, and merges the parts' schemas in a distributed job; no list of files passes
    through the driver's Python. Zero-byte files are skipped. Parts may order their columns differently; a
    column missing from some parts is null there. A given ``schema`` is read as it is. With no non-empty part the
    given ``schema`` yields an empty frame, otherwise it fails.
    """
    reader = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    if schema is not None:
        return reader.schema(schema).parquet(path)
    parts = list_files(spark, path, "*.parquet").filter(F.col("length") > 0)
    if parts.isEmpty():
        raise ValueError(f"no non-empty parquet part below {path}")
    # a footer that cannot be read is passed over for the schema only (empty files have none); the scan itself passes over empty files alone
    merged = reader.option("mergeSchema", "true").option("ignoreCorruptFiles", "true").parquet(path).schema
    return reader.schema(merged).parquet(path)


def classify_format(files: DataFrame, dataset: str, name: str = "name") -> DataFrame:
    """Per dataset the reader to use, by the fixed precedence of :data:`FORMATS`.

    One aggregate per dataset over its file list: ``(dataset, format, n_files)``.
    """
    n = F.col(name)
    agg = files.groupBy(dataset).agg(
        F.max(n.endswith(".parquet").cast("int")).alias("__pq"),
        F.sum(n.endswith(".csv").cast("int")).alias("__csv"),
        F.max(n.endswith("abc").cast("int")).alias("__abc"),
        F.max(n.endswith(".rds").cast("int")).alias("__rds"),
        F.max(n.endswith(".h5").cast("int")).alias("__h5"),
        F.count(F.lit(1)).alias("n_files"),
    )
    fmt = (
        F.when(F.col("__pq") == 1, "parquet")
        .when((F.col("__csv") == 1) & (F.col("n_files") == 1), "csv")
        .when(F.col("__abc") == 1, "abc")
        .when(F.col("__rds") == 1, "rds")
        .when(F.col("__h5") == 1, "h5")
        .otherwise("paths")
    )
    return agg.select(dataset, fmt.alias("format"), "n_files")


def read_delimited(spark: SparkSession, path: str, infer: bool = True, multiline: bool = False, schema=None) -> DataFrame:
    """Delimited text with a header row kept verbatim as column names.

    A quote inside a quoted field is doubled. ``multiline`` allows line breaks inside quoted fields; such a file cannot be
    split, so one task reads it whole.
    """
    reader = spark.read.option("header", True).option("escape", '"').option("multiLine", multiline)
    reader = reader.schema(schema) if schema is not None else reader.option("inferSchema", infer)
    return reader.csv(path)


def path_table(spark: SparkSession, path: str) -> DataFrame:
    """Fallback for data that is not a table: one row per file, ``value`` = path."""
    return list_files(spark, path).select(F.col("path").alias("value"), "name", "length")


def save_dataset(df: DataFrame, path: str, force: bool = False) -> str:
    """Materialize ``df`` as parquet; an existing dataset is an error unless ``force``."""
    df.write.mode("overwrite" if force else "errorifexists").parquet(path)
    return path


def reload_dataset(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def load_dataset(spark: SparkSession, path: str, schema=None, multiline: bool = False) -> tuple[str, DataFrame]:
    """Read a downloaded dataset folder with the reader its file list calls for.

    Returns ``(format, frame)``: parquet parts appended by name, a single CSV (or a
    file named ``...abc``) read with its header, and for R objects (``.rds``,
    ``.h5``) or anything else the path table, since those are not tables.
    """
    listing = list_files(spark, path)
    found = classify_format(listing.withColumn("dataset", F.lit(path)), "dataset").first()
    fmt = found["format"] if found else "paths"  # an empty folder is an empty path table
    if fmt == "parquet":
        return fmt, load_parts(spark, path, schema)
    if fmt in ("csv", "abc"):
        suffix = ".csv" if fmt == "csv" else "abc"
        target = [r["path"] for r in listing.filter(F.col("name").endswith(suffix)).select("path").collect()]
        return fmt, read_delimited(spark, target, multiline=multiline)
    return fmt, path_table(spark, path)
