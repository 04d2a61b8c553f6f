"""What several operators share: intermediate tables, and Arrow batches of bounded size."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.session import scratch_dir

#: Python functions take texts from a batch in blocks of about so many bytes, so that memory follows the longest row.
BLOCK_BYTES = 8 * 1024 * 1024


#: Rows that Spark hands to Python at once, where the session has Spark's default of 10,000: texts can be long.
BATCH_ROWS = 1_000


def prepare(spark: SparkSession) -> None:
    """Let Python workers import this library from where the driver has it, unless a path is set for them already, and
    have them work on smaller batches than is usual for short rows."""
    spark.sparkContext.environment.setdefault("PYTHONPATH", str(Path(__file__).resolve().parents[2]))
    setting = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if spark.conf.get(setting) == "10000":
        spark.conf.set(setting, str(BATCH_ROWS))


#: Lets Spark delete the shuffle files of an execution as soon as it has ended.
_CLEANED = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write a frame to the shared folder of ``spark.checkpoint.dir`` and read it back: lost executors cost no rerun.

    The shuffles that led to it are needed no more, and their files go at once: else they would stay on the executors' disks
    until the driver happens to collect its garbage.
    """
    path, conf = scratch_dir(df.sparkSession, f"llm-{label}"), df.sparkSession.conf
    before = conf.get(_CLEANED, "false")
    conf.set(_CLEANED, "true")
    try:
        df.write.parquet(path)
    finally:
        conf.set(_CLEANED, before)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def blocks(batches: Iterator[pa.RecordBatch], column: str, most: int = BLOCK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut record batches so that the named string column holds about ``most`` bytes, or one row, in each."""
    for batch in batches:
        sizes = [len(v) if v is not None else 0 for v in (x.as_buffer() for x in batch.column(column))]
        start = held = 0
        for row, size in enumerate(sizes):
            if row > start and held + size > most:
                yield batch.slice(start, row - start)
                start, held = row, 0
            held += size
        if batch.num_rows > start:
            yield batch.slice(start)


#: Of the GNU C library; others give memory back by themselves, or not at all.
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)


def release() -> None:
    """Give freed memory back to the system.  Python workers outlive their tasks, and the allocators keep what a task has freed:
    without this a worker holds the most that it has ever needed, for as long as the session lasts."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def released(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function for ``mapInArrow`` after which its worker holds no more memory than it still uses."""

    def each(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return each


def wide_hash(*columns: Column) -> list[Column]:
    """Two 64-bit hashes of the columns with unlike seeds: 128 bits, so that no two of 10^12 rows should meet."""
    return [F.xxhash64(F.lit(seed), *columns) for seed in ("first", "second")]


def words(text: Column) -> Column:
    """The words of a text: maximal runs of letters, digits and marks of any script, in lower case."""
    return F.regexp_extract_all(F.lower(text), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))


def mix64(x: np.ndarray) -> np.ndarray:
    """The finishing steps of SplitMix64, for arrays of unsigned 64-bit numbers."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return x ^ (x >> np.uint64(31))
