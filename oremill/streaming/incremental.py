"""Incremental file ingest as a stream: each file is read exactly once, over any number of runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from oremill.functions import file_name, file_timestamp
from oremill.schemas import declared
from oremill.sources.delimited import null_option

# The partition column of ingested tables: the number of the micro-batch that brought a row.  It only grows, whatever
# clocks say, so it tells a refresh what is new.
INGEST_BATCH = "ingest_batch"


def file_stream(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    files_per_batch: int | None = None,
    null_value: str | None = None,
    **options: str,
) -> DataFrame:
    """A stream over the header CSV files of a folder, with lineage columns.

    ``files_per_batch`` bounds one micro-batch, so a large backlog is taken in steps that fit the cluster.
    """
    reader = spark.readStream.schema(schema).options(header=True, escape='"', recursiveFileLookup=True, **options)
    reader = reader.options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, **null_option(null_value))
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    path = F.col("_metadata.file_path")
    return reader.csv(landing).withColumns({"FILE_NAME": file_name(path), "FILE_TS": file_timestamp(path)})


def ingested(spark: SparkSession, target: str, schema: StructType) -> DataFrame:
    """An ingested table, also before its first row; ``schema`` is that of the files."""
    columns = StructType([*schema.fields, *declared(f"FILE_NAME STRING, FILE_TS STRING, ingest_ts TIMESTAMP, {INGEST_BATCH} BIGINT").fields])
    spark.createDataFrame([], columns).write.mode("ignore").partitionBy(INGEST_BATCH).parquet(target)
    return spark.read.schema(columns).parquet(target)


def ingest_new_files(
    spark: SparkSession,
    landing: str,
    schema: StructType,
    target: str,
    checkpoint: str,
    at: Column | None = None,
    files_per_batch: int | None = None,
    null_value: str | None = None,
) -> int:
    """Append the rows of files not seen before to ``target`` and stop; returns the number of rows added.

    The checkpoint remembers the files.  Every micro-batch is written as the partition of its number, replacing what an
    attempt that died may have left there, so nothing is lost or doubled.  The number of rows is counted in the target,
    over the partitions of this run.
    """
    stamped = F.current_timestamp() if at is None else at
    before = ingested(spark, target, schema).agg(F.max(INGEST_BATCH).alias("batch")).first()["batch"]

    def write(batch: DataFrame, number: int) -> None:
        rows = batch.withColumns({"ingest_ts": stamped, INGEST_BATCH: F.lit(number).cast("bigint")})
        writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        writer.partitionBy(INGEST_BATCH).parquet(target)

    query = (
        file_stream(spark, landing, schema, files_per_batch, null_value)
        .writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    added = ingested(spark, target, schema)
    return (added if before is None else added.filter(F.col(INGEST_BATCH) > before)).count()
