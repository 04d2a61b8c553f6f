"""Tables clustered by several columns at once: a filter on any of them reads few files.

A row's value in each column is replaced by its rank among boundaries that cut the column into parts of about as many rows.
The bits of the ranks are interleaved to one Morton key, rows are dealt into files by ranges of it, and so a file covers a
narrow range of every column.  What it covers is kept in a small table beside the files: smallest and largest value and
number of NULLs of each column.  A reader takes from it the files that can hold what a filter asks for.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oremill.sinks.loads import materialize

#: A column is cut into 2 to the power of so many parts.
RANK_BITS = 6
#: Rows that boundaries are taken from.  They decide which file a row goes to, and nothing else.
SAMPLED_ROWS = 20_000
#: A value of the most frequent kind may fill many files: ties of the key are broken by a hash of the row.
TIES = 1 << 16


def boundaries(df: DataFrame, columns: list[str], bits: int = RANK_BITS, sampled: int = SAMPLED_ROWS) -> dict[str, list]:
    """For each column the values at which its ranks change, in order; NULLs are left out.

    A frequent value occurs among them as often as it fills parts, so that ranks use all their bits.

    Taken from about ``sampled`` rows, chosen by a hash of their values: the driver holds no more, whatever the table's size.
    """
    total = df.count()
    share = min(1.0, sampled / max(1, total))
    at = F.pmod(F.xxhash64(*columns), F.lit(1 << 30)) < F.lit(int(share * (1 << 30)))
    rows = df.select(*columns).filter(at).limit(2 * sampled).collect()
    found = {}
    for column in columns:
        values = sorted(r[column] for r in rows if r[column] is not None)
        found[column] = [values[len(values) * k >> bits] for k in range(1, 1 << bits)] if values else []
    return found


def rank(column: str, cuts: list, kind: T.DataType) -> Column:
    """How many of the boundaries are not above the value, found by halving; a NULL has rank 0."""

    def below(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        middle = (low + high) // 2
        return F.when(F.col(column) >= F.lit(cuts[middle]).cast(kind), below(middle + 1, high)).otherwise(below(low, middle))

    return F.when(F.col(column).isNull(), F.lit(0)).otherwise(below(0, len(cuts)))


def morton(ranks: list[Column], bits: int = RANK_BITS) -> Column:
    """The bits of the ranks, one after the other, highest first."""
    key = F.lit(0).cast("long")
    for n, value in enumerate(ranks):
        for bit in range(bits):
            one = F.shiftright(value.cast("long"), bit).bitwiseAND(F.lit(1))
            key = key.bitwiseOR(F.shiftleft(one, bit * len(ranks) + len(ranks) - 1 - n))
    return key


def write_clustered(df: DataFrame, path: str, columns: list[str], files: int, bits: int = RANK_BITS, sampled: int = SAMPLED_ROWS) -> DataFrame:
    """Write a table clustered by ``columns`` in about ``files`` files, and return what the files cover.

    The frame is read several times (for its boundaries, for the ranges of its keys, and to be written): pass a stored one.
    Rows of one value, or with NULLs, may fill several files, and any number of them gives the same table.  An empty frame
    gives a table without rows.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    cuts = boundaries(df, columns, bits, sampled)
    key = morton([rank(c, cuts[c], kinds[c]) for c in columns], bits)
    ties = F.pmod(F.xxhash64(*df.columns), F.lit(TIES))
    placed = df.withColumns({"_morton": key, "_ties": ties}).repartitionByRange(files, "_morton", "_ties")
    placed.sortWithinPartitions(*columns).drop("_morton", "_ties").write.mode("overwrite").parquet(f"{path}/data")
    return _covered(df.sparkSession, path, df.schema, columns)


def _covered(spark: SparkSession, path: str, schema: T.StructType, columns: list[str]) -> DataFrame:
    stored = spark.read.schema(schema).parquet(f"{path}/data")
    per_column = [e for c in columns for e in (F.min(c).alias(f"{c}_min"), F.max(c).alias(f"{c}_max"), F.count_if(F.col(c).isNull()).alias(f"{c}_nulls"))]
    cover = stored.groupBy(F.col("_metadata.file_path").alias("file")).agg(F.count(F.lit(1)).alias("file_rows"), *per_column)
    cover.coalesce(1).write.mode("overwrite").parquet(f"{path}/cover")
    return spark.read.schema(cover.schema).parquet(f"{path}/cover")


def files_for(cover: DataFrame, wanted: dict[str, tuple]) -> list[str]:
    """The files that may hold rows with each column within its bounds, both included; None leaves a side open."""
    found = cover
    for column, (low, high) in wanted.items():
        if low is not None:
            found = found.filter(F.col(f"{column}_max") >= F.lit(low))
        if high is not None:
            found = found.filter(F.col(f"{column}_min") <= F.lit(high))
    return sorted(r["file"] for r in found.select("file").collect())


def read_clustered(spark: SparkSession, path: str, wanted: dict[str, tuple]) -> DataFrame:
    """The rows with each column of ``wanted`` within its bounds, both included; only files that may hold such are read.

    A NULL is within no bounds.  Bounds on columns that the table is not clustered by are filters alone.
    """
    schema = spark.read.parquet(f"{path}/data").schema
    cover = spark.read.parquet(f"{path}/cover")
    clustered = {c: bounds for c, bounds in wanted.items() if f"{c}_min" in cover.columns}
    files = files_for(cover, clustered)
    rows = spark.read.schema(schema).parquet(*files) if files else spark.createDataFrame([], schema)
    for column, (low, high) in wanted.items():
        if low is not None:
            rows = rows.filter(F.col(column) >= F.lit(low))
        if high is not None:
            rows = rows.filter(F.col(column) <= F.lit(high))
        if low is None and high is None:
            rows = rows.filter(F.col(column).isNotNull())
    return rows


def recluster(spark: SparkSession, path: str, to: str, columns: list[str], files: int) -> DataFrame:
    """Cluster a stored table anew, by other columns or in another number of files, at another place."""
    return write_clustered(materialize(spark.read.parquet(f"{path}/data"), "recluster"), to, columns, files)
