"""Table-to-table loads by load type: what one metadata row with a load query asks for."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from oremill.operators.dedup import latest_per_key
from oremill.operators.upsert import increment_since
from oremill.sinks.loads import LoadResult, load_from_query, materialize
from oremill.sinks.versions import VersionedTable

# The load types of table loads; any other appends.
UPSERT, OVERWRITE, APPEND = "UPSERT", "OVERWRITE", "APPEND"

Build = Callable[[DataFrame], DataFrame]


def load_table(source: DataFrame, target: str, load_type: str, build: Build | None = None) -> LoadResult:
    """APPEND or OVERWRITE a stored table with the source, or with what ``build`` makes of it."""
    return load_from_query(build(source) if build else source, target, load_type)


def _present(stored: DataFrame, rows: DataFrame, keys: list[str]) -> int:
    """How many of some rows a stored table holds, by a hash of all columns."""
    columns = rows.columns
    found = stored.select(*columns).select(*keys, F.xxhash64(*columns).alias("_row"))
    return rows.select(*keys, F.xxhash64(*columns).alias("_row")).join(found, [*keys, "_row"], "left_semi").count()


def upsert_table(
    source: DataFrame,
    target: VersionedTable,
    keys: list[str],
    merge_column: str | None = None,
    build: Build | None = None,
) -> LoadResult:
    """Upsert the source rows that are newer, by ``merge_column``, than the newest target row.

    Without a merge column all rows are taken.  Of several new rows of a key the latest counts.  Without new rows
    nothing is written and the counts are 0 and 0.  Else they are the merged rows, and those of the new version that
    equal one of them.
    """
    first = target.current() is None
    fresh = source if first else increment_since(target.read(), source, merge_column)
    fresh = build(fresh) if build else fresh
    newest = [merge_column] if merge_column and merge_column in fresh.columns else []
    increment = materialize(latest_per_key(fresh, keys, newest), "increment")
    rows = increment.agg(F.count(F.lit(1)).alias("rows")).first()["rows"]
    if not rows:
        return LoadResult(target.path, UPSERT, 0, 0)
    stored = target.read(target.upsert(increment, keys))
    return LoadResult(target.path, UPSERT, rows, _present(stored, increment, keys))


def run_table_load(spark: SparkSession, row: Row, root: str, keys: list[str]) -> LoadResult:
    """Run the load that one row of the ingest metadata asks for.

    Tables are folders ``<root>/<schema>/<table>``.  ``load_query`` is a query over ``{source}``, the source table; without
    one all of it is loaded.  ``UPSERT`` takes the source rows newer, by the column ``merge_cols``, than the target has,
    all of them if none is named, and merges what the query makes of them on ``keys`` into a versioned table;
    ``OVERWRITE`` replaces the target, and any other type appends.
    """
    source = spark.read.parquet(f"{root}/{row['source_schema']}/{row['source_table']}")
    target = f"{root}/{row['target_schema']}/{row['target_table']}"
    query, kind = row["load_query"], (row["load_type"] or APPEND).strip().upper()

    def build(rows: DataFrame) -> DataFrame:
        return spark.sql(query, source=rows) if query else rows

    if kind == UPSERT:
        column = row["merge_cols"] if row["merge_cols"] not in (None, "", "null") else None
        return upsert_table(source, VersionedTable(spark, target), keys, column, build)
    return load_table(source, target, OVERWRITE if kind == OVERWRITE else APPEND, build)
