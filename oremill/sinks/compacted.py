"""Append-only logs whose readers see a snapshot and a short tail.

Every append is a segment, a folder with the next number.  After so many segments the rows that still decide anything are
written as a snapshot up to that number, from the snapshot before and the tail since: compaction never reads the whole log
either.  A reader takes the newest snapshot and the segments after it.  All segments stay, for whoever wants the history.

A folder counts once Spark has marked its write as complete (``_SUCCESS``); what a writer that died has left is written
over by the next one.  One writer at a time.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructField, StructType

_SEGMENT, _UP_TO = "segment", "up_to"


class CompactedLog:
    def __init__(self, spark: SparkSession, path: str, schema: StructType, deciding: Callable[[DataFrame], DataFrame], every: int = 20):
        """``deciding`` picks the rows of a log that later readers need.  It has to give the same for a log as for a log of
        which a part has been replaced by what it picked there; picking the newest or largest per key does."""
        if every < 1:
            raise ValueError("a snapshot takes one segment at least")
        self.spark, self.path, self.schema = spark, path.rstrip("/"), schema
        self.deciding, self.every = deciding, every

    def append(self, rows: DataFrame) -> int:
        """Store the next segment, and after ``every`` of them a snapshot; returns the segment's number."""
        taken = self._snapshot()
        number = self._last(taken) + 1
        rows.select(*self.schema.names).write.mode("overwrite").parquet(self._folder(_SEGMENT, number))
        if number - taken >= self.every:
            self._compact(taken, number)
        return number

    def read(self) -> DataFrame:
        """The deciding rows: those of the newest snapshot, and all since.  At most ``every`` segments are opened."""
        taken = self._snapshot()
        return self._rows(taken, self._last(taken))

    def history(self) -> DataFrame:
        """All rows ever appended, with the number of their segment."""
        last = self._last(self._snapshot())
        if not last:
            return self._none().withColumn(_SEGMENT, F.lit(0))
        numbered = StructType([*self.schema.fields, StructField(_SEGMENT, IntegerType())])
        return self.spark.read.schema(numbered).parquet(f"{self.path}/log").filter(F.col(_SEGMENT) <= last)

    def _compact(self, taken: int, last: int) -> None:
        self.deciding(self._rows(taken, last)).select(*self.schema.names).write.mode("overwrite").parquet(self._folder(_UP_TO, last))

    def _rows(self, taken: int, last: int) -> DataFrame:
        folders = [self._folder(_UP_TO, taken)] if taken else []
        folders += [self._folder(_SEGMENT, n) for n in range(taken + 1, last + 1)]
        return self.spark.read.schema(self.schema).parquet(*folders) if folders else self._none()

    def _none(self) -> DataFrame:
        return self.spark.createDataFrame([], self.schema)

    def _folder(self, kind: str, number: int) -> str:
        return f"{self.path}/{'log' if kind == _SEGMENT else 'snapshots'}/{kind}={number}"

    def _snapshot(self) -> int:
        """How far the newest complete snapshot goes; 0 without one.  Names are listed, files are not opened."""
        pattern = self._hadoop_path(f"{self.path}/snapshots/{_UP_TO}=*/_SUCCESS")
        found = self._files(pattern).globStatus(pattern) or []
        return max((int(f.getPath().getParent().getName().split("=")[1]) for f in found), default=0)

    def _last(self, taken: int) -> int:
        """The newest complete segment, looked for from the snapshot on."""
        number = taken
        while True:
            mark = self._hadoop_path(f"{self._folder(_SEGMENT, number + 1)}/_SUCCESS")
            if not self._files(mark).exists(mark):
                return number
            number += 1

    def _hadoop_path(self, name: str):
        return self.spark._jvm.org.apache.hadoop.fs.Path(name)

    def _files(self, path):
        return path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())
