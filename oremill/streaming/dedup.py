"""Repeated rows dropped as they arrive, and late ones set aside.

The stream remembers a key for as long as a repeat of it can be in time: until the watermark, which follows the newest
event by a fixed delay, has passed the key's event by that delay.  So its state holds the keys of one delay, however long
it runs.  What comes behind the watermark cannot be judged any more; Spark drops such rows, and here they are found again
as the ingested rows whose key was not accepted, stored apart and counted.
"""

from __future__ import annotations

from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oremill.schemas import declared
from oremill.sinks.loads import append, ensure, replace_partitions
from oremill.streaming.incremental import INGEST_BATCH

EVENT_TIME = "event_ts"
_JUDGED = declared(f"{INGEST_BATCH} BIGINT")


class Judged(NamedTuple):
    accepted: int
    late: int
    repeated: int


def without_repeats(stream: DataFrame, keys: list[str], delay: str) -> DataFrame:
    """One row per key of a stream with the column ``event_ts``, as long as repeats are no more than ``delay`` apart."""
    return stream.withWatermark(EVENT_TIME, delay).dropDuplicatesWithinWatermark(keys)


def accept_new_rows(
    spark: SparkSession, source: str, schema: StructType, target: str, keys: list[str], event_time: Column, delay: str
) -> Judged:
    """Take the rows of a table of ``ingest_new_files`` that came since the last call; returns what became of them.

    ``target/accepted`` gets one row per key with its ``event_ts``, ``target/late`` the rows behind the watermark and
    those without a time, both by ``ingest_batch``.  ``schema`` has the columns of the source, ``ingest_batch`` last, and
    ``event_time`` works out the time of a row.  A late row of a key that was accepted within the delay before is a
    repeat.  NULL keys are one key.

    Every step replaces the partitions of its batches, and a batch counts as judged only when all are written, so a call
    that died is completed by the next.
    """
    spark.createDataFrame([], schema).write.mode("ignore").partitionBy(INGEST_BATCH).parquet(source)
    rows = spark.readStream.schema(schema).parquet(source).withColumn(EVENT_TIME, event_time.cast("timestamp"))
    # Batches that are ingested while this runs are judged by the next call.
    up_to = spark.read.schema(schema).parquet(source).agg(F.max(INGEST_BATCH).alias("batch")).first()["batch"]

    def write(batch: DataFrame, number: int) -> None:
        # A query on one line of batches: what an attempt that died has left of this one is replaced.
        numbered = batch.withColumn("micro_batch", F.lit(number).cast("bigint"))
        numbered.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("micro_batch").parquet(f"{target}/accepted")

    query = (
        without_repeats(rows.filter(F.col(EVENT_TIME).isNotNull()), keys, delay)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", f"{target}/checkpoint")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()

    judged = ensure(spark, f"{target}/judged", _JUDGED).agg(F.max(INGEST_BATCH).alias("batch")).first()["batch"]
    landed = spark.read.schema(schema).parquet(source).withColumn(EVENT_TIME, event_time.cast("timestamp"))
    new = (F.col(INGEST_BATCH) <= F.lit(up_to)) & (F.lit(True) if judged is None else F.col(INGEST_BATCH) > judged)
    landed = landed.filter(new)
    span = landed.agg(
        F.count(F.lit(1)).alias("rows"), (F.min(EVENT_TIME) - F.expr(f"INTERVAL {delay}")).alias("since"),
    ).first()
    if not span["rows"]:
        return Judged(0, 0, 0)
    accepted = accepted_rows(spark, target, schema)
    # No row of these batches repeats an event from before the delay, so older files are not read.
    near = accepted.filter(F.lit(span["since"]).isNull() | (F.col(EVENT_TIME) >= F.lit(span["since"])))
    known = near.select(*[F.col(k).alias(f"_{n}") for n, k in enumerate(keys)])
    same = reduce(Column.__and__, [F.col(k).eqNullSafe(F.col(f"_{n}")) for n, k in enumerate(keys)])
    replace_partitions(landed.join(known, same, "left_anti"), f"{target}/late", [INGEST_BATCH])
    taken, late = accepted.filter(new).count(), late_rows(spark, target, schema).filter(new).count()
    append(spark.range(1).select(F.lit(up_to).cast("bigint").alias(INGEST_BATCH)).coalesce(1), f"{target}/judged")
    return Judged(taken, late, span["rows"] - taken - late)


def accepted_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows accepted so far, with their ``event_ts``; ``schema`` is that of the source."""
    return _table(spark, f"{target}/accepted", [*schema.fields, *declared(f"{EVENT_TIME} TIMESTAMP, micro_batch BIGINT").fields], "micro_batch").drop("micro_batch")


def late_rows(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """The rows set aside so far."""
    return _table(spark, f"{target}/late", [*schema.fields, *declared(f"{EVENT_TIME} TIMESTAMP").fields], INGEST_BATCH)


def _table(spark: SparkSession, path: str, fields: list, partition: str) -> DataFrame:
    columns = StructType(fields)
    spark.createDataFrame([], columns).write.mode("ignore").partitionBy(partition).parquet(path)
    return spark.read.schema(columns).parquet(path)
