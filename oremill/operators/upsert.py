"""Upserts as DataFrame algebra: target and source in, new state out.

Contract, as for a MERGE: source keys are unique; target rows missing from the source stay; a NULL key matches
nothing.  :func:`key_violations` finds rows that break it, and a versioned table refuses such a source.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oremill.operators.dedup import latest_per_key

# Fixed value: the watermark of an empty target.
FIRST_MERGE_WATERMARK = "1990-01-01 00:00:00"


def key_violations(source: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once or hold a NULL, with their counts."""
    has_null = F.lit(False)
    for key in keys:
        has_null = has_null | F.col(key).isNull()
    return source.groupBy(*keys).agg(F.count(F.lit(1)).alias("copies")).filter((F.col("copies") > 1) | has_null)


def upsert(target: DataFrame, source: DataFrame, keys: list[str], update: list[str] | None = None) -> DataFrame:
    """Update matched rows, insert the others.  ``update`` limits which columns a match changes.

    A full outer join, which evaluates each side once: right for a source of about the target's size, such as a
    recomputed mart.  Keys are unique on both sides, so no key is hot.
    """
    columns = target.columns
    changed = set(columns if update is None else [*keys, *update])
    old = target.select(F.lit(True).alias("_old"), *[F.col(c).alias(f"_old_{c}") for c in columns])
    new = source.select(F.lit(True).alias("_new"), *columns)
    match = [F.col(f"_old_{k}") == F.col(k) for k in keys]

    def pick(column: str) -> Column:
        take_new = F.col("_new") if column in changed else F.col("_new") & F.col("_old").isNull()
        return F.when(take_new, F.col(column)).otherwise(F.col(f"_old_{column}")).alias(column)

    return old.join(new, match, "full_outer").select(*[pick(c) for c in columns])


def matching(rows: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """The rows whose key is in ``keys`` (``left_semi``) or is not (``left_anti``); a NULL matches a NULL."""
    named = keys.select(*[F.col(k).alias(f"_key_{k}") for k in keys.columns])
    match = [F.col(k).eqNullSafe(F.col(f"_key_{k}")) for k in keys.columns]
    return rows.join(named, match, how)


def merge_increment(target: DataFrame, increment: DataFrame, keys: list[str], null_safe: bool = False) -> DataFrame:
    """Upsert a small, stored increment: target rows it replaces are dropped, then it is added.

    As in a MERGE a NULL key matches nothing; ``null_safe`` lets it match a NULL, as grouping by the key does.

    The anti join lets Spark broadcast the increment's keys when it measures them small, and then the target is not
    shuffled.  The increment is read twice, so pass a stored one, not a costly query.
    """
    if null_safe:
        keep = matching(target, increment.select(*keys), "left_anti")
    else:
        keep = target.join(increment.select(*keys), keys, "left_anti").select(*target.columns)
    return keep.unionByName(increment.select(*target.columns))


def replace_window(target: DataFrame, source: DataFrame, in_window: Column) -> DataFrame:
    """Replace all target rows of a window by the source, so that rows that vanished there go as well; no join.

    Target rows for which the window test is NULL lie outside it and stay.
    """
    outside = target.filter(~F.coalesce(in_window, F.lit(False)))
    return outside.unionByName(source.select(*target.columns))


def increment_since(target: DataFrame, source: DataFrame, merge_column: str | None) -> DataFrame:
    """Source rows newer than the newest target row, by ``merge_column``; all rows if none is given.

    The watermark is a scalar subquery: one plan, and its value reaches the source scan as a filter.
    """
    if not merge_column:
        return source
    mark = target.agg(F.max(merge_column).alias("mark")).scalar()
    first = F.lit(FIRST_MERGE_WATERMARK).cast("timestamp")
    return source.filter(F.col(merge_column) > F.coalesce(mark, first))


def upsert_since_watermark(
    target: DataFrame,
    source: DataFrame,
    keys: list[str],
    merge_column: str | None,
    build: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """Upsert what is new in the source; ``build`` turns new rows into target rows.  Nothing new changes nothing.

    Of several new rows of a key the latest wins.
    """
    fresh = increment_since(target, source, merge_column)
    fresh = build(fresh) if build else fresh
    newest = [merge_column] if merge_column and merge_column in fresh.columns else []
    return upsert(target, latest_per_key(fresh.select(*target.columns), keys, newest), keys)
