"""One row per key, and rankings within a key."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oremill.sinks.loads import materialize


def latest_per_key(
    df: DataFrame, keys: list[str], newest_first: list[str], order: list[str] | None = None
) -> DataFrame:
    """Keep, per key, the row that is last by ``newest_first``; rows with a NULL key form one group.

    Remaining ties are broken by ``order`` (default: every other column), so the survivor does not depend on how
    rows are partitioned; only rows equal in all of these are interchangeable.

    The filter on ``row_number`` makes Spark drop all but one row per key in each task *before* the shuffle, so a
    key that holds a third of the table arrives as one row per task.  The window is led by a 64-bit hash of the key:
    both sorts then compare one long instead of text that shares a prefix (``ITEM-...``).
    """
    rest = order if order is not None else [c for c in df.columns if c not in keys and c not in newest_first]
    window = Window.partitionBy(F.xxhash64(*keys), *keys).orderBy(
        *[F.col(c).desc_nulls_last() for c in [*newest_first, *rest]]
    )
    return df.withColumn("_rank", F.row_number().over(window)).filter("_rank = 1").drop("_rank")


def dedup_by_key(df: DataFrame, keys: list[str]) -> DataFrame:
    """One row per key; among different rows of a key the greatest by column order stays."""
    return latest_per_key(df, keys, [])


_ROWS_BITS = 33  # monotonically_increasing_id: the partition above, the row within it below


def rank_within(df: DataFrame, keys: list[str], newest_first: str, ties: list[str], rank: str = "rn") -> DataFrame:
    """``row_number`` of each row within its key, newest first, with no task that sees a whole key.

    All rows are sorted over all tasks by key, time and ties; a key's rows may fill many partitions, whatever they have
    in common.  The sorted rows are stored with their partition and place in it.  With the rows of earlier partitions
    that is a row's place in the whole, and its rank is the distance from the first place of its key.  NULLs come last,
    and NULL keys are keys like any other.  ``ties`` should tell rows of a key and time apart; rows equal in all of it
    are ranked in any order.
    """
    order = [*[F.col(k).asc_nulls_first() for k in keys], *[F.col(c).desc_nulls_last() for c in [newest_first, *ties]]]
    place = F.monotonically_increasing_id().alias("_place")
    ordered = materialize(df.orderBy(*order).select("*", place, F.struct(*keys).alias("_key")), "ordered")
    partition = F.shiftright("_place", _ROWS_BITS).alias("_partition")
    sizes = ordered.groupBy(partition).agg(F.count(F.lit(1)).alias("_rows"))
    # One row for each partition of the sort.
    earlier = Window.orderBy("_partition").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select("_partition", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROWS_BITS) - 1))
    placed = ordered.withColumn("_partition", partition).join(starts, "_partition").withColumn("_at", F.col("_start") + within)
    firsts = ordered.groupBy("_key").agg(F.min("_place").alias("_first"))
    first_at = firsts.withColumn("_partition", F.shiftright("_first", _ROWS_BITS)).join(starts, "_partition")
    offset = F.col("_first").bitwiseAND(F.lit((1 << _ROWS_BITS) - 1)) + F.col("_start")
    # Stored, so that the join has a shuffle of its own, in which Spark splits a key of very many rows.
    first_at = materialize(first_at.select("_key", offset.alias("_first_at")), "first-places")
    ranked = placed.join(first_at, "_key")
    return ranked.select(*df.columns, (F.col("_at") - F.col("_first_at") + 1).cast("long").alias(rank))
