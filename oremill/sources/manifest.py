"""File manifests: which files there are, which is newest, which are new since a watermark."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed value: the watermark of a task that has never run.
FIRST_WATERMARK = "1900-01-01 00:00:00"


def file_manifest(spark: SparkSession, path: str, glob: str | None = None, oldest_first: bool = False) -> DataFrame:
    """``path, name, size, modified`` of every file under ``path``, sorted only if asked.

    File contents are not read: the scan is pruned to its metadata.
    """
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", True)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    files = reader.load(path).select(
        F.col("_metadata.file_path").alias("path"),
        F.col("_metadata.file_name").alias("name"),
        F.col("_metadata.file_size").alias("size"),
        F.col("_metadata.file_modification_time").alias("modified"),
    )
    return files.orderBy("modified", "path") if oldest_first else files


def latest_file(files: DataFrame, run_date: str = "", by: tuple[str, ...] = ()) -> DataFrame:
    """The newest file (per ``by`` group), optionally only among paths that contain ``run_date``.

    No matching file gives no row.  Of several files of the same time the last path wins.
    """
    if run_date:
        files = files.filter(F.col("path").like(f"%{run_date}%"))
    newest = files.groupBy(*by).agg(F.max(F.struct("modified", "path")).alias("newest"))
    return newest.filter(F.col("newest").isNotNull()).select(*by, "newest.path", "newest.modified")


def latest_file_containing(files: DataFrame, text: str, by: tuple[str, ...] = ()) -> DataFrame:
    """The newest file whose path contains ``text``, e.g. ``monthly``."""
    return latest_file(files.filter(F.col("path").contains(text)), by=by)


def files_after(files: DataFrame, watermark: Column | str = FIRST_WATERMARK) -> DataFrame:
    """Files modified after one watermark."""
    mark = F.lit(watermark).cast("timestamp") if isinstance(watermark, str) else watermark
    return files.filter(F.col("modified") > mark)


def new_files_since(files: DataFrame, watermarks: DataFrame, by: tuple[str, ...]) -> DataFrame:
    """Files newer than the watermark of their own ``by`` group; groups without a watermark take all files.

    ``watermarks`` has the ``by`` columns and ``watermark``, one row per group.
    """
    first = F.lit(FIRST_WATERMARK).cast("timestamp")
    return (
        files.join(watermarks, list(by), "left")
        .filter(F.col("modified") > F.coalesce(F.col("watermark"), first))
        .select(*files.columns)
    )


def counts_per_file(files: DataFrame, scan: DataFrame) -> DataFrame:
    """``path, name, row_count`` of each file of the manifest; a file without rows counts 0.

    ``scan`` must come straight from a file reader.  A header-only file yields no rows to group, hence the left
    join from the manifest.
    """
    counts = scan.groupBy(F.col("_metadata.file_path").alias("path")).agg(F.count(F.lit(1)).alias("row_count"))
    return files.join(counts, "path", "left").select(
        "path", "name", F.coalesce("row_count", F.lit(0)).alias("row_count")
    )
