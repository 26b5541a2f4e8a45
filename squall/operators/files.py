"""Service-log error search and dataset size report."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from squall.constants import LOG_ERROR_PATTERN


def read_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """Log files as lines (column ``value``), with the file each came from."""
    return spark.read.text(path).select("value", F.col("_metadata.file_path").alias("file_path"))


def error_lines(lines: DataFrame, col: str = "value", pattern: str = LOG_ERROR_PATTERN) -> DataFrame:
    """Lines matching the (case-insensitive) error pattern."""
    return lines.where(F.col(col).rlike(pattern))


def _decoded(uri: Column) -> Column:
    """A file's path without scheme and host, as it is named on disk (URIs escape spaces and others)."""
    bare = F.regexp_replace(uri, "^[a-zA-Z][a-zA-Z0-9+.-]*:(//[^/]*)?", "")
    return F.url_decode(F.regexp_replace(bare, "\\+", "%2B"))  # a plus sign in a path is no space


def dataset_size(spark: SparkSession, path: str) -> DataFrame:
    """Files, bytes and rows per top-level entry under ``path``, plus a total
    row (entry null), like a disk-usage listing of a dataset folder.

    Every file that Spark lists counts in files and bytes (names that begin
    with a dot or an underscore are hidden from it); rows are those of the
    ``.parquet`` files, null for an entry without any. Sizes and counts come
    from the file metadata columns of two scans that read no content, joined on
    the same URI. The listing itself is Spark's file index: names of all files
    on the driver, as for any scan.
    """
    root = _bare_root(spark, path)
    listing = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(path)
    files = listing.select(F.col("_metadata.file_path").alias("uri"), F.col("_metadata.file_size").alias("length"))
    parquet = spark.read.schema("_none INT").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    counts = parquet.parquet(path).groupBy(F.col("_metadata.file_path").alias("uri")).agg(F.count(F.lit(1)).alias("n"))
    inside = F.substr(_decoded(F.col("uri")), F.lit(len(root) + 2))
    rows = F.when(F.col("uri").endswith(".parquet"), F.coalesce("n", F.lit(0)))
    per_file = files.join(counts, "uri", "left").select(
        F.substring_index(inside, "/", 1).alias("entry"), "length", rows.alias("rows")
    )
    report = per_file.rollup("entry").agg(
        F.count(F.lit(1)).alias("files"), F.sum("length").alias("bytes"), F.sum("rows").alias("rows")
    )
    return report.withColumn("size", human_size(F.col("bytes")))


def _bare_root(spark: SparkSession, path: str) -> str:
    """The qualified path without scheme and host."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark._jsc.hadoopConfiguration())
    return p.makeQualified(fs.getUri(), fs.getWorkingDirectory()).toUri().getPath().rstrip("/")


def human_size(nbytes: Column) -> Column:
    """Bytes as a short human-readable size (``512``, ``54.4 K``, ``1.2 G``), 1024-based."""
    units = ["K", "M", "G", "T", "P"]
    b = nbytes.cast("double")
    expr = F.when(b < 1024, nbytes.cast("string"))
    for i, unit in enumerate(units, start=1):
        expr = expr.when(b < F.lit(1024.0) ** (i + 1), F.concat(F.format_string("%.1f", b / F.lit(1024.0) ** i), F.lit(f" {unit}")))
    return expr.otherwise(F.concat(F.format_string("%.1f", b / F.lit(1024.0) ** len(units)), F.lit(" P")))
