"""Delimited files with their malformed lines set aside.

Spark's permissive reader fills what it can and says nothing.  Here a line whose number of fields is not that of the
declared schema goes to the rejects, whole, with its file and the reason; all others are rows.  Nothing is lost: a file's
lines are its rows and its rejects, and that is counted.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oremill.functions import file_name, file_timestamp
from oremill.sinks.loads import materialize
from oremill.sources.delimited import null_option

LINE, REASON, EXPECTED, FOUND = "line", "reason", "expected_fields", "found_fields"
TOO_FEW, TOO_MANY, OPEN_QUOTE = "TOO_FEW_FIELDS", "TOO_MANY_FIELDS", "OPEN_QUOTE"


@dataclass(frozen=True)
class Scan:
    """What was read: ``rows`` with the declared columns, ``rejects``, both with ``FILE_NAME`` and ``FILE_TS``."""

    rows: DataFrame
    rejects: DataFrame

    def counts(self) -> DataFrame:
        """``FILE_NAME, good_rows, rejected_rows, source_count``, one row per file that has a line."""
        each = self.rows.select("FILE_NAME", F.lit(1).alias("good"), F.lit(0).alias("bad")).unionByName(
            self.rejects.select("FILE_NAME", F.lit(0).alias("good"), F.lit(1).alias("bad"))
        )
        total = each.groupBy("FILE_NAME").agg(F.sum("good").alias("good_rows"), F.sum("bad").alias("rejected_rows"))
        return total.withColumn("source_count", F.col("good_rows") + F.col("rejected_rows"))


def without_quoted(line: Column, delimiter: str) -> Column:
    """A line without its quoted fields: they start and end with a quote, and hold doubled quotes only.  A quote anywhere
    else in a field is a character like any other."""
    quoted = rf'(^|\Q{delimiter}\E)"(?:[^"]|"")*"(?=\Q{delimiter}\E|$)'
    return F.when(F.contains(line, F.lit('"')), F.regexp_replace(line, quoted, "$1")).otherwise(line)


def field_count(line: Column, delimiter: str) -> Column:
    """The number of fields of a line: one more than there are delimiters outside quoted fields."""
    plain = without_quoted(line, delimiter)
    shorter = F.length(plain) - F.length(F.replace(plain, F.lit(delimiter), F.lit("")))
    return (shorter / len(delimiter) + 1).cast("int")


def reason(line: Column, delimiter: str, expected: int) -> Column:
    """Why a line is not a row."""
    found = field_count(line, delimiter)
    open_quote = F.regexp_like(without_quoted(line, delimiter), F.lit(rf'(^|\Q{delimiter}\E)"'))
    return F.when(open_quote, OPEN_QUOTE).when(found < expected, TOO_FEW).when(found > expected, TOO_MANY)


def read_with_rejects(
    spark: SparkSession, path: str | list[str], schema: T.StructType, delimiter: str = ",", header: bool = True,
    null_value: str | None = None,
) -> Scan:
    """Read delimited files by position with a declared schema of text columns.

    A line with too few or too many fields, or with a quote that is not closed on it, is rejected; an empty line is no line.
    Fields may be quoted and hold delimiters and doubled quotes, but no line breaks: files are cut into lines first, so that
    they can be read in splits.  A header is the first line of each file and is not counted.  A schema with columns named
    like those that are added is refused.

    Files are read once: their lines are stored with the reason, and rows and rejects are read from there.
    """
    clash = {LINE, REASON, "FILE_NAME", "FILE_TS"} & set(schema.names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are named like those that are added")
    if any(not isinstance(f.dataType, T.StringType) for f in schema.fields):
        raise ValueError("raw columns are text: cast them after the load")
    # Lines as they stand: no field separator or quote occurs in them.
    reader = spark.read.schema(T.StructType([T.StructField(LINE, T.StringType())]))
    lines = reader.options(header=header, sep="\x01", quote="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)
    source = F.col("_metadata.file_path")
    lineage = [file_name(source).alias("FILE_NAME"), file_timestamp(source).alias("FILE_TS")]
    why = reason(F.col(LINE), delimiter, len(schema.names)).alias(REASON)
    stored = materialize(lines.select(LINE, why, *lineage), "lines")
    rejected = stored.filter(F.col(REASON).isNotNull()).select(
        "FILE_NAME", "FILE_TS", LINE, REASON, F.lit(len(schema.names)).alias(EXPECTED), field_count(F.col(LINE), delimiter).alias(FOUND)
    )
    return Scan(_parsed(stored.filter(F.col(REASON).isNull()), schema, delimiter, null_value), rejected)


def _parsed(lines: DataFrame, schema: T.StructType, delimiter: str, null_value: str | None) -> DataFrame:
    options = {"sep": delimiter, "escape": '"', "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false", **null_option(null_value)}
    fields = F.from_csv(F.col(LINE), ", ".join(f"`{name}` STRING" for name in schema.names), options)
    return lines.select(fields.alias("_fields"), "FILE_NAME", "FILE_TS").select("_fields.*", "FILE_NAME", "FILE_TS")


def retried(rejects: DataFrame, schema: T.StructType, repair: Column, delimiter: str = ",", null_value: str | None = None) -> DataFrame:
    """Rejected lines parsed again after ``repair``, a column of the mended line, as rows with their lineage.

    Lines that still do not have as many fields as the schema, or that ``repair`` makes NULL, are left out.
    """
    mended = rejects.withColumn(LINE, repair)
    whole = mended.filter(reason(F.col(LINE), delimiter, len(schema.names)).isNull() & F.col(LINE).isNotNull())
    return _parsed(whole, schema, delimiter, null_value)
