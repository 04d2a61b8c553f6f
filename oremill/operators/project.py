"""Renames, schema alignment and audit stamps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def rename_columns(df: DataFrame, names: dict[str, str]) -> DataFrame:
    return df.withColumnsRenamed(names)


def align_to_schema(df: DataFrame, schema: StructType) -> DataFrame:
    """The columns of ``schema``, in its order and types; others are dropped, a missing one is an error."""
    return df.select(*[F.col(f.name).cast(f.dataType.simpleString()).alias(f.name) for f in schema.fields])


def stamp(df: DataFrame, column: str, at: Column | None = None) -> DataFrame:
    """Add an audit timestamp; ``at`` fixes it, the default is the time of the query."""
    return df.withColumn(column, F.current_timestamp() if at is None else at)
