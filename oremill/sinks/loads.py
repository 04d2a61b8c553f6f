"""Load modes with audit columns, each a single pass that also counts what it writes."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oremill.session import scratch_dir

LINEAGE = ("FILE_NAME", "FILE_TS")
APPEND_TYPES = ("APPEND", "UPSERT")
OVERWRITE_TYPES = ("OVERWRITE", "OVERWRITE_ONLY_LOAD_BY")


@dataclass(frozen=True)
class LoadResult:
    target: str
    load_type: str
    source_count: int
    target_count: int

    @property
    def status(self) -> str:
        return "COMPLETED" if self.source_count == self.target_count else "FAILED"


def is_path(target: str) -> bool:
    return "/" in target


def read_target(spark: SparkSession, target: str) -> DataFrame:
    """A stored table, given by path or by catalog name."""
    return spark.read.parquet(target) if is_path(target) else spark.table(target)


def ensure(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """A stored table that may not have been written yet: it is created empty if there is none."""
    spark.createDataFrame([], schema).write.mode("ignore").parquet(path)
    return spark.read.schema(schema).parquet(path)


def with_audit(
    df: DataFrame,
    load_type: str,
    user: Column | str | None = None,
    at: Column | None = None,
    task_name: str | None = None,
) -> DataFrame:
    """Add the audit columns of a load type after the payload; lineage columns, where present, come last.

    ``APPEND`` and ``OVERWRITE`` add ``LOAD_BY, LOAD_TS``; ``OVERWRITE_ONLY_LOAD_BY`` adds ``LOAD_BY``;
    ``UPSERT`` (an append, despite its name) adds ``CRT_BY, CRT_TS, UPD_BY, UPD_TS`` with the task as the actor.
    """
    kind = load_type.upper()
    who = F.current_user() if user is None else (F.lit(user) if isinstance(user, str) else user)
    when = F.current_timestamp() if at is None else at
    body = [c for c in df.columns if c not in LINEAGE]
    lineage = [c for c in LINEAGE if c in df.columns]
    if kind in ("APPEND", "OVERWRITE"):
        if kind == "OVERWRITE" and len(lineage) < len(LINEAGE):
            raise ValueError("OVERWRITE needs FILE_NAME and FILE_TS; read the files with with_lineage()")
        return df.select(*body, who.alias("LOAD_BY"), when.alias("LOAD_TS"), *lineage)
    if kind == "OVERWRITE_ONLY_LOAD_BY":
        return df.select(*body, who.alias("LOAD_BY"))
    if kind == "UPSERT":
        actor = F.lit(task_name)
        return df.select(
            *body, actor.alias("CRT_BY"), when.alias("CRT_TS"), actor.alias("UPD_BY"), when.alias("UPD_TS")
        )
    raise ValueError(f"unknown load type {load_type!r}")


def write(df: DataFrame, target: str, mode: str, partition_by: tuple[str, ...] = ()) -> int:
    """Write a frame and return its row count, from the same pass.

    The count is observed right under the writer, in the job's last stage, where a lost executor's tasks are not
    counted twice.
    """
    seen = Observation()
    writer = df.observe(seen, F.count(F.lit(1)).alias("rows")).write.mode(mode).format("parquet")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.save(target) if is_path(target) else writer.saveAsTable(target)
    return seen.get["rows"]


def append(df: DataFrame, target: str) -> int:
    return write(df, target, "append")


def overwrite(df: DataFrame, target: str) -> int:
    """Replace a table.  ``df`` must not read ``target``; use a versioned table for that."""
    return write(df, target, "overwrite")


def replace_partitions(df: DataFrame, target: str, by: list[str]) -> None:
    """Overwrite only those partitions of a table that ``df`` has rows for.

    The form of an upsert where the key, or a coarser column, is the partition: days outside the window are neither
    read nor rewritten.  Rows are rebalanced by partition: small partitions get one file, and one that holds much of
    the data is split over tasks.
    """
    spread = df.hint("rebalance", *[F.col(c) for c in by])
    writer = spread.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by)
    writer.parquet(target) if is_path(target) else writer.saveAsTable(target)


def stored_rows(spark: SparkSession, target: str) -> int:
    """Rows of a stored table, 0 before its first load; no column is read."""
    try:
        return read_target(spark, target).count()
    except AnalysisException as error:
        if error.getCondition() in ("PATH_NOT_FOUND", "TABLE_OR_VIEW_NOT_FOUND", "UNABLE_TO_INFER_SCHEMA"):
            return 0
        raise


# The partition of a load that can be run again: what its watermark was.
LOAD_FROM = "LOAD_FROM"


def load(
    df: DataFrame,
    target: str,
    load_type: str,
    user: Column | str | None = None,
    at: Column | None = None,
    task_name: str | None = None,
    load_from: str | None = None,
) -> LoadResult:
    """Load a frame by load type.  An unknown type is an error, not an empty load.

    With ``load_from`` appended rows become the partition ``LOAD_FROM`` of that name, in place of what an earlier attempt
    may have left there, so a load that died can be run again.

    The source is counted as it is read; the target afterwards, from what it then holds: the partition, the whole
    of an overwritten table, or how much an appended one has gained.  Only file footers are read for that.
    """
    kind = load_type.upper()
    spark, replaces = df.sparkSession, kind in OVERWRITE_TYPES
    seen = Observation()
    audited = with_audit(df.observe(seen, F.count(F.lit(1)).alias("rows")), kind, user, at, task_name)
    if load_from is not None and not replaces:
        # One partition, written where the rows are read: the count above is then part of the job's last stage.
        writer = audited.withColumn(LOAD_FROM, F.lit(load_from)).write.mode("overwrite").partitionBy(LOAD_FROM)
        writer.option("partitionOverwriteMode", "dynamic").parquet(target)
        stored = read_target(spark, target).filter(F.col(LOAD_FROM).cast("string") == load_from).count()
    else:
        before = 0 if replaces else stored_rows(spark, target)
        write(audited, target, "overwrite" if replaces else "append")
        stored = stored_rows(spark, target) - before
    return LoadResult(target, kind, seen.get["rows"], stored)


def load_from_query(df: DataFrame, target: str, mode: str) -> LoadResult:
    """Insert the result of a query, APPEND or OVERWRITE; counted as by :func:`load`."""
    kind = mode.upper()
    if kind not in ("APPEND", "OVERWRITE"):
        raise ValueError(f"unknown load type {mode!r}")
    before = stored_rows(df.sparkSession, target) if kind == "APPEND" else 0
    count = write(df, target, kind.lower())
    return LoadResult(target, kind, count, stored_rows(df.sparkSession, target) - before)


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Store a frame in the shared scratch folder and read it back: a stable snapshot with its lineage cut."""
    path = scratch_dir(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


#: Stored bytes of a bucket: what one task writes, and later reads, at once.  Rows take several times as much in a shuffle.
BUCKET_BYTES = 4 * 1024 * 1024


def bucket_count(tables: list[DataFrame], key: str, least: int, bucket_bytes: int = BUCKET_BYTES) -> int:
    """How many buckets stored tables that are bucketed alike by ``key`` should have: as many as keep one at about
    ``bucket_bytes``, however large the tables.

    No more than let an average bucket hold the largest key, which one bucket has to take anyway, nor than Spark allows, and at
    least ``least``.
    """
    wanted, fits = least, [int(tables[0].sparkSession.conf.get("spark.sql.sources.bucketing.maxBuckets"))]
    for df in tables:
        files = df.groupBy("_metadata.file_path").agg(F.first("_metadata.file_size").alias("bytes"))
        wanted = max(wanted, -(-(files.agg(F.sum("bytes").alias("bytes")).first()["bytes"] or 0) // bucket_bytes))
    if wanted > least:
        for df in tables:
            per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
            size = per_key.agg(F.max("rows").alias("largest"), F.sum("rows").alias("total")).first()
            fits.append((size["total"] or 0) // max(1, size["largest"] or 0))
    return max(least, min([wanted, *fits]))


def write_bucketed(df: DataFrame, table: str, key: str, buckets: int) -> None:
    """Write a catalog table bucketed and sorted by ``key``.

    Two tables bucketed alike on their join key join, and aggregate on that key, without a shuffle.  But all rows of
    a bucket are then read by one task, so a key with more rows than an average bucket is refused: such a table is better
    written plainly and shuffled when it is used.  ``df`` is read twice, so pass a stored table.
    """
    per_key = df.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))
    size = per_key.agg(F.max("rows").alias("largest"), F.sum("rows").alias("total")).first()
    if (size["largest"] or 0) * buckets > (size["total"] or 0):
        raise ValueError(f"a {key} of {table} has {size['largest']} of {size['total']} rows, too many for one of {buckets} buckets")
    # One task per bucket writes one file per bucket.
    together = df.repartition(buckets, key)
    together.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(table)
