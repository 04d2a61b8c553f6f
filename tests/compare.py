"""Order-insensitive comparison of a Spark result with DuckDB's."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        path = Path(sf_dir) / f"{table}.parquet"
        if path.exists():
            connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{path}'")
    return connection


def _value(value):
    if value is None:
        return "<NULL>"
    if isinstance(value, float) and math.isnan(value):
        return "<NaN>"
    if isinstance(value, float):
        return f"{value:.2f}"
    return str(value)


def spark_rows(df) -> list[tuple]:
    columns = sorted(df.columns)
    return sorted(tuple(_value(row[c]) for c in columns) for row in df.collect())


def duckdb_rows(connection, sql: str) -> tuple[list[str], list[tuple]]:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    order = sorted(range(len(names)), key=names.__getitem__)
    return sorted(names), sorted(tuple(_value(row[i]) for i in order) for row in cursor.fetchall())
