"""Session settings and the shared scratch folder."""

from __future__ import annotations

import uuid
from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

# Left to the cluster: executor counts, memory, shuffle.partitions.  These only steer Catalyst and AQE.
SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Split a skewed join side even where that costs one more shuffle afterwards.
    "spark.sql.adaptive.forceOptimizeSkewedJoin": "true",
    # A small date window of orders prunes the items scan by a Bloom filter of its order ids.  The filter is
    # bounded by maxNumBits (8 MB); creation side and item count are bounded too, beyond them none is built.
    "spark.sql.optimizer.runtime.bloomFilter.enabled": "true",
    "spark.sql.optimizer.runtime.bloomFilter.creationSideThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold": "1GB",
    "spark.sql.optimizer.runtime.bloomFilter.maxNumBits": "67108864",
    # Noting the line each column expression was built on takes longer than building it.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def tuned(builder: SparkSession.Builder) -> SparkSession.Builder:
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    return builder


def scratch_dir(spark: SparkSession, label: str) -> str:
    """A fresh folder name under the shared folder the cluster names in ``spark.checkpoint.dir``.

    Without that setting the caller has to choose a folder by ``SparkContext.setCheckpointDir``.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
    return f"{root.rstrip('/')}/{label}-{uuid.uuid4().hex}"


SHUFFLE_PARTITION_BYTES = 256 * 1024 * 1024
INITIAL_PARTITIONS = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"


def shuffle_partitions(input_bytes: int, floor: int) -> int:
    """How many partitions a shuffle of all of the input should start with; AQE merges those that come out small.

    Stored columns take several times their compressed size in a shuffle; four is allowed for.  The driver keeps a record
    for each map task and partition: for inputs of tens of terabytes raise ``SHUFFLE_PARTITION_BYTES`` with the memory
    of a task.
    """
    return max(floor, -(-4 * input_bytes // SHUFFLE_PARTITION_BYTES))


@contextmanager
def sized_shuffles(spark: SparkSession, input_bytes: int) -> Iterator[int]:
    """Within the block, shuffles start with partitions that fit a task whatever the size of the input."""
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    count = shuffle_partitions(input_bytes, int(spark.conf.get("spark.sql.shuffle.partitions")))
    spark.conf.set(INITIAL_PARTITIONS, str(count))
    try:
        yield count
    finally:
        if before is None:
            spark.conf.unset(INITIAL_PARTITIONS)
        else:
            spark.conf.set(INITIAL_PARTITIONS, before)
