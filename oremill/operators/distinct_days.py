"""Distinct counts over any span of days from bitmaps kept by day.

Counts of distinct values cannot be added up: a customer who buys on two days is one customer.  Bitmaps can be united.  Every
value has a number, a day keeps one bit for each number it has seen, in pieces of 32,768 bits, and a span of days, of any
length, is the union of its days' bitmaps.  The count is exact.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oremill.sinks.loads import materialize

#: monotonically_increasing_id: the partition above, the row within it below.
_ROWS_BITS = 33


def numbered(values: DataFrame, key: str, known: DataFrame | None = None) -> DataFrame:
    """``key, number``: a number for each different value, from 0 without gaps.  NULL has none.

    With ``known``, an earlier result, its values keep their numbers and new ones go on from there: bitmaps that are stored
    stay right.  Numbers are given within the partitions of the different values, and partitions are counted: no task sees
    all of them.
    """
    fresh = values.select(key).filter(F.col(key).isNotNull()).distinct()
    if known is not None:
        fresh = fresh.join(known, key, "left_anti")
    placed = materialize(fresh.withColumn("_place", F.monotonically_increasing_id()), "numbered")
    part = F.shiftright("_place", _ROWS_BITS).alias("_part")
    sizes = placed.groupBy(part).agg(F.count(F.lit(1)).alias("_rows"))
    earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)  # a row for each partition
    starts = sizes.select("_part", F.coalesce(F.sum("_rows").over(earlier), F.lit(0)).alias("_start"))
    first = 0 if known is None else known.count()
    within = F.col("_place").bitwiseAND(F.lit((1 << _ROWS_BITS) - 1))
    new = placed.withColumn("_part", part).join(starts, "_part").select(key, (F.col("_start") + within + F.lit(first)).alias("number"))
    return new if known is None else known.select(key, "number").unionByName(new)


def bitmaps(rows: DataFrame, groups: list[str], number: str = "number") -> DataFrame:
    """``groups, piece, bits``: the numbers that each group has, as bitmaps.  A row without a number adds nothing.

    Spark sets bits in each task before it shuffles: a hot group sends one bitmap for each task and piece.
    """
    some = rows.filter(F.col(number).isNotNull()).withColumn("piece", F.bitmap_bucket_number(number))
    return some.groupBy(*groups, "piece").agg(F.bitmap_construct_agg(F.bitmap_bit_position(number)).alias("bits"))


def united(kept: DataFrame, groups: list[str]) -> DataFrame:
    """Bitmaps of coarser groups, such as months from days: ``groups, piece, bits``."""
    return kept.groupBy(*groups, "piece").agg(F.bitmap_or_agg("bits").alias("bits"))


def counted(kept: DataFrame, groups: list[str], name: str) -> DataFrame:
    """The number of different values of each group, over all rows of ``kept`` that are in it."""
    return united(kept, groups).groupBy(*groups).agg(F.sum(F.bitmap_count("bits")).alias(name))


def add_days(kept: DataFrame, more: DataFrame, groups: list[str]) -> DataFrame:
    """Kept bitmaps with those of new rows: what a day has seen already is not counted twice."""
    return united(kept.unionByName(more.select(*kept.columns)), groups)
