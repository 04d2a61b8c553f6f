"""Delimited text readers.  Columns are never inferred: a schema is declared, or everything is text.

An empty field is NULL, quoted or not.  Where files tell NULL from empty text, name their marker of NULL as ``null_value``:
then that is NULL, and a quoted empty field (``""``, as Spark writes empty text) is empty text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from oremill.functions import file_name, file_timestamp
from oremill.sinks.loads import materialize


def null_option(null_value: str | None) -> dict[str, str]:
    """The reader option for a marker of NULL; without one Spark's rule holds, that an empty field is NULL."""
    return {} if null_value is None else {"nullValue": null_value}


def read_with_schema(
    spark: SparkSession, path: str | list[str], schema: T.StructType, null_value: str | None = None, **options: str
) -> DataFrame:
    """Header CSV read by position with a declared schema; names in the header do not matter.

    A schema with more columns than the file gives NULL for the tail.
    """
    return spark.read.schema(schema).options(header=True, **null_option(null_value), **options).csv(path)


def read_delimited(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "csv",
    header: bool = True,
    delimiter: str = ",",
    null_value: str | None = None,
) -> DataFrame:
    """Every column as text, named by the header."""
    reader = spark.read.format(file_format).options(header=header, sep=delimiter, inferSchema=False)
    return reader.options(**null_option(null_value)).load(path)


def read_quoted(
    spark: SparkSession,
    path: str | list[str],
    file_format: str = "csv",
    header: bool = True,
    delimiter: str = ",",
    null_value: str | None = None,
) -> DataFrame:
    """As :func:`read_delimited`, for files that double a quote inside quotes; blanks at the ends are kept."""
    return (
        spark.read.format(file_format)
        .options(header=header, sep=delimiter, inferSchema=False, escape='"')
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **null_option(null_value))
        .load(path)
    )


def with_lineage(scan: DataFrame) -> DataFrame:
    """Add ``FILE_NAME`` and ``FILE_TS``; ``scan`` must come straight from a file reader."""
    path = F.col("_metadata.file_path")
    return scan.withColumns({"FILE_NAME": file_name(path), "FILE_TS": file_timestamp(path)})


def skip_leading_rows(scan: DataFrame, count: int | None, keep: tuple[str, ...] = ()) -> DataFrame:
    """Drop the first ``count`` data rows of each file; ``scan`` must come straight from a file reader.

    Rows keep their place: a narrow first pass (no data column is read) counts the rows of each input split, from
    which the few splits that hold skipped rows are known, with the position of the first row to keep in each.  These
    cuts, a row for each such split, are stored, so that their size is known when the second pass is planned.  It drops
    rows before that position; while the cuts are within Spark's broadcast threshold file contents are not shuffled, and
    a file whose skipped rows fill several splits is right as well.  ``monotonically_increasing_id`` gives positions in file order,
    since one split is read by one task from front to back, and both passes share one listing of the files.

    ``keep`` names ``_metadata`` fields to carry along, e.g. ``("file_path",)``.
    """
    columns = scan.columns
    tagged = scan.select(
        *columns,
        *[F.col(f"_metadata.{name}").alias(name) for name in keep],
        F.col("_metadata.file_path").alias("_file"),
        F.col("_metadata.file_block_start").alias("_split"),
        F.monotonically_increasing_id().alias("_position"),
    )
    if not count:
        return tagged.select(*columns, *keep)
    splits = tagged.groupBy("_file", "_split").agg(
        F.count(F.lit(1)).alias("_rows"), F.min("_position").alias("_first")
    )
    earlier = Window.partitionBy("_file").orderBy("_split").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (
        splits.withColumn("_left", F.lit(count) - F.coalesce(F.sum("_rows").over(earlier), F.lit(0)))
        .filter("_left > 0")
        .select("_file", "_split", (F.col("_first") + F.col("_left")).alias("_keep_from"))
    )
    cuts = materialize(cuts, "cuts")
    return (
        tagged.join(cuts, ["_file", "_split"], "left")
        .filter(F.col("_keep_from").isNull() | (F.col("_position") >= F.col("_keep_from")))
        .select(*columns, *keep)
    )
