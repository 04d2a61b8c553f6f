"""Sums kept up to date by changes with a sign, without the rows they were summed from.

A change is a row with the column ``sign``: -1 for a row that went, 1 for one that came; a changed row is both.  A kept sum
has, for each measure, the sum and the number of rows that had a value, so that the sum becomes NULL again when the last of
them goes, and the number of all rows, so that the group goes when its last row does.  Amounts are summed as decimals: what
is taken away was added exactly so before, and nothing is left of it.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

SIGN = "sign"
#: Amounts in kept sums: eight decimals, and below 10^20 each.  A larger one counts as no amount.
AMOUNT = "decimal(28,8)"
KEPT = "decimal(38,8)"


def signed(gone: DataFrame, come: DataFrame) -> DataFrame:
    """Rows that went and rows that came as changes."""
    return gone.select(F.lit(-1).cast("long").alias(SIGN), "*").unionByName(come.select(F.lit(1).cast("long").alias(SIGN), "*"))


def net(changes: DataFrame) -> DataFrame:
    """Changes with equal rows added up; rows that came as often as they went are gone.  A sign may then be 2 or more."""
    rest = [c for c in changes.columns if c != SIGN]
    summed = changes.groupBy(*rest).agg(F.sum(SIGN).alias(SIGN))
    return summed.filter(F.col(SIGN) != 0).select(*changes.columns)


def every(changes: list[DataFrame], key: str) -> DataFrame:
    """The keys that any of the changes has, without NULL."""
    return reduce(DataFrame.unionByName, [c.select(key) for c in changes]).filter(F.col(key).isNotNull()).distinct()


def summed(
    rows: DataFrame, keys: list[str], count: str, wholes: dict[str, Column] | None = None, amounts: dict[str, Column] | None = None
) -> DataFrame:
    """Kept sums of rows, or the change of kept sums if the rows have signs.

    ``count`` names the number of rows.  A measure ``m``, of whole numbers or of amounts, gives ``m``, the sum of its values,
    and ``m_values``, how many rows had one.  NULL keys form a group.
    """
    sign = F.col(SIGN) if SIGN in rows.columns else F.lit(1).cast("long")
    sums = [F.sum(sign).alias(count)]
    for name, value in (wholes or {}).items():
        sums += [_known(value, sign, name), F.coalesce(F.sum(sign * value), F.lit(0)).cast("long").alias(name)]
    for name, value in (amounts or {}).items():
        exact = value.try_cast(AMOUNT)
        # Of these types, so that the product keeps all decimals.
        total = F.sum(sign.cast("decimal(9,0)") * exact)
        sums += [_known(exact, sign, name), F.coalesce(total, F.lit(0)).cast(KEPT).alias(name)]
    return rows.groupBy(*keys).agg(*sums)


def _known(value: Column, sign: Column, name: str) -> Column:
    return F.coalesce(F.sum(F.when(value.isNotNull(), sign)), F.lit(0)).alias(f"{name}_values")


def regrouped(sums: DataFrame, keys: list[str], count: str, measures: list[str]) -> DataFrame:
    """Kept sums by coarser keys, each row of ``sums`` counting once; or their change if the rows have signs of 1 and -1."""
    sign = F.col(SIGN) if SIGN in sums.columns else F.lit(1).cast("long")
    total = [F.sum(sign).alias(count)]
    for name in [n for m in measures for n in (f"{m}_values", m)]:
        total.append(_same(F.sum(F.when(sign < 0, -F.col(name)).otherwise(F.col(name))), sums, name))
    return sums.groupBy(*keys).agg(*total)


def add_up(sums: DataFrame, change: DataFrame, keys: list[str], count: str) -> DataFrame:
    """Kept sums and a change of them: the sums after it, without groups that have no row left.

    A union and one aggregation, which Spark starts before the shuffle: no join, and a NULL key is a key like any other.
    """
    measures = [c for c in sums.columns if c not in keys]
    both = sums.unionByName(change.select(*sums.columns))
    total = both.groupBy(*keys).agg(*[_same(F.sum(c), sums, c) for c in measures])
    return total.filter(F.col(count) != 0).select(*sums.columns)


def _same(total: Column, sums: DataFrame, name: str) -> Column:
    """A total in the type of its column, so that sums of sums can be stored beside sums."""
    return total.cast(sums.schema[name].dataType).alias(name)


def value_of(measure: str, kind: str) -> Column:
    """A kept measure as a sum reads: NULL where no row has a value."""
    return F.when(F.col(f"{measure}_values") > 0, F.col(measure)).cast(kind)
