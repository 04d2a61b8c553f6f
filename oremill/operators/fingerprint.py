"""Whether two tables hold the same rows, and which rows differ, without moving the rows that do not.

Rows are dealt into ranges of the hashes of their keys.  A range's fingerprint does not depend on the order of its rows: how
many there are, the exclusive or of their hashes, and a sum of parts of other hashes, which tells rows apart that exclusive
or cancels.  Ranges with equal fingerprints are done with.  The others are cut into finer ranges, level by level, and only
rows in ranges that differ on the last level are compared themselves.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oremill.operators.retract import SIGN, net, signed
from oremill.sinks.loads import materialize

#: Bits of the key's hash that tell ranges apart, level by level.
LEVELS = (12, 28)
#: Summed bits of a row's second hash: sums of a range stay exact up to 2^40 rows.
SUMMED_BITS = 23

MISSING, EXTRA, CHANGED = "MISSING", "EXTRA", "CHANGED"
RANGE, PRINT = "key_range", ["row_count", "hash_xor", "hash_sum"]


def _hash(columns: list[str], seed: str) -> Column:
    """A hash of columns; a NULL counts by its place."""
    absent = [F.col(c).isNull() for c in columns]
    return F.xxhash64(F.lit(seed), *absent, *[F.col(c) for c in columns])


def key_range(keys: list[str], bits: int) -> Column:
    """The range of a key: the highest bits of its hash.  A NULL is a key like any other."""
    return F.shiftrightunsigned(_hash(keys, "key"), 64 - bits)


def fingerprints(rows: DataFrame, keys: list[str], columns: list[str] | None = None, bits: int = LEVELS[0]) -> DataFrame:
    """``key_range, row_count, hash_xor, hash_sum``: one row for each range of keys that has rows.

    ``columns`` are compared besides the keys (default: all others).  Spark combines the rows of a range in each task, so
    that a task sends one row for each range, however many rows or copies of a row there are.
    """
    all_of = _compared(rows, keys, columns)
    part = _hash(all_of, "second").bitwiseAND(F.lit((1 << SUMMED_BITS) - 1))
    return rows.groupBy(key_range(keys, bits).alias(RANGE)).agg(
        F.count(F.lit(1)).alias("row_count"), F.bit_xor(_hash(all_of, "first")).alias("hash_xor"), F.sum(part).alias("hash_sum")
    )


def _compared(rows: DataFrame, keys: list[str], columns: list[str] | None) -> list[str]:
    return [*keys, *(c for c in (rows.columns if columns is None else columns) if c not in keys)]


def differing_ranges(source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, bits: int = LEVELS[0]) -> DataFrame:
    """Ranges in which two tables differ, with the fingerprints of both: NULL where a side has no rows."""
    sides = [
        fingerprints(rows, keys, columns, bits).select(RANGE, *[F.col(c).alias(f"{side}_{c}") for c in PRINT])
        for side, rows in (("source", source), ("target", target))
    ]
    same = [F.col(f"source_{c}").eqNullSafe(F.col(f"target_{c}")) for c in PRINT]
    return sides[0].join(sides[1], RANGE, "full_outer").filter(~(same[0] & same[1] & same[2]))


def differences(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """``keys, difference, source_rows, target_rows``: one row for each key whose rows are not the same on both sides.

    ``MISSING`` are keys with more rows in the source and none in the target that the source lacks, ``EXTRA`` the other way
    round, and ``CHANGED`` have rows on both sides that the other side lacks; the counts are of those rows.  Rows are
    compared as often as they occur, and NULL equals NULL.  Tables without a difference give no rows.

    Both tables are read once for each level and once for the rows, with the keys and ``columns`` alone; pass stored ones.
    Only ranges travel, and the rows in ranges that differ.  Ranges that differ are kept as a table, not on the driver.
    """
    all_of = _compared(source, keys, columns)
    sides = [rows.select(*all_of) for rows in (source, target)]
    for bits in levels:
        ranges = materialize(differing_ranges(*sides, keys, bits=bits).select(RANGE), "ranges")
        # Filtered by ranges of the level above, which hold all of the next one's.
        sides = [_within(rows, ranges, keys, bits) for rows in sides]
    missing_or_extra = net(signed(sides[1], sides[0]))
    plus, minus = (F.sum(F.when(F.col(SIGN) * k > 0, F.col(SIGN) * k)) for k in (1, -1))
    per_key = missing_or_extra.groupBy(*keys).agg(
        F.coalesce(plus, F.lit(0)).alias("source_rows"), F.coalesce(minus, F.lit(0)).alias("target_rows")
    )
    kind = F.when(F.col("target_rows") == 0, MISSING).when(F.col("source_rows") == 0, EXTRA).otherwise(CHANGED)
    return per_key.select(*keys, kind.alias("difference"), "source_rows", "target_rows")


def _within(rows: DataFrame, ranges: DataFrame, keys: list[str], bits: int) -> DataFrame:
    return rows.withColumn(RANGE, key_range(keys, bits)).join(ranges, RANGE, "left_semi").drop(RANGE)


def reconcile_contents(
    source: DataFrame, target: DataFrame, keys: list[str], columns: list[str] | None = None, levels: tuple[int, ...] = LEVELS
) -> DataFrame:
    """One row: the counts of both sides, how many keys are missing, extra and changed, and whether the load is COMPLETED.

    Unlike a comparison of counts it fails a load that lost one row and doubled another.
    """
    found = differences(source, target, keys, columns, levels)
    kinds = {name: F.count_if(F.col("difference") == kind).alias(name) for name, kind in (("missing", MISSING), ("extra", EXTRA), ("changed", CHANGED))}
    counts = [rows.agg(F.count(F.lit(1)).alias(name)) for rows, name in ((source, "source_count"), (target, "target_count"))]
    one = found.agg(*kinds.values())
    for count in counts:  # one row each
        one = one.withColumn("_one", F.lit(1)).join(count.withColumn("_one", F.lit(1)), "_one").drop("_one")
    status = F.when((F.col("missing") == 0) & (F.col("extra") == 0) & (F.col("changed") == 0), "COMPLETED").otherwise("FAILED")
    return one.select("source_count", "target_count", *kinds, status.alias("load_status"))
