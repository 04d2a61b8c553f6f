"""Tables that are rewritten from themselves: each commit is a new folder, and a small log names them.

Plain parquet has no MERGE, no time travel, and refuses to overwrite what is being read.  So a commit writes the
whole new state to ``v=<n>`` and then appends one row to the log.  A reader takes the newest logged version, or an
older one by number.  A version that failed half-way is not in the log and is written over by the next commit.  One
writer at a time.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from oremill.operators.upsert import key_violations, upsert
from oremill.schemas import declared
from oremill.sinks.loads import ensure, materialize, overwrite

LOG = declared("version INT, row_count BIGINT, mark STRING, committed_ts TIMESTAMP")


class VersionedTable:
    LOG = LOG

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path.rstrip("/")

    def history(self) -> DataFrame:
        """``version, row_count, mark, committed_ts``, and more where a table notes more; one row per commit."""
        return ensure(self.spark, f"{self.path}/log", self.LOG)

    def latest(self) -> Row | None:
        """The newest commit, or None for a table without commits."""
        return self.history().agg(F.max(F.struct(*self.LOG.names)).alias("commit")).first()["commit"]

    def current(self) -> int | None:
        commit = self.latest()
        return commit["version"] if commit else None

    def read(self, version: int | None = None) -> DataFrame:
        """The current state, or the state as of ``version``."""
        number = self.current() if version is None else version
        if number is None:
            raise LookupError(f"{self.path} has no committed version")
        return self.spark.read.parquet(f"{self.path}/v={number}")

    def commit(self, df: DataFrame, mark: str | None = None) -> int:
        """Store ``df`` as the next version and make it current; returns its number.

        ``mark`` notes how far the table's sources had got, so that a refresh can tell whether there is work to do.
        """
        number = (self.current() or 0) + 1
        rows = overwrite(df, f"{self.path}/v={number}")
        entry = self.spark.range(1).select(
            F.lit(number).alias("version"), F.lit(rows).cast("long").alias("row_count"),
            F.lit(mark).cast("string").alias("mark"), F.current_timestamp().alias("committed_ts"),
        )
        entry.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        return number

    def upsert(
        self, source: DataFrame, keys: list[str], update: list[str] | None = None, mark: str | None = None
    ) -> int:
        """Commit the current state with ``source`` upserted into it; the first commit stores the source as it is.

        Repeated or NULL keys are refused.  The source is stored first, since the check and the upsert both read it.
        """
        source = materialize(source, "upsert-source")
        broken = key_violations(source, keys).limit(3).collect()
        if broken:
            raise ValueError(f"upsert source has repeated or NULL keys, e.g. {[r.asDict() for r in broken]}")
        version = self.current()
        state = source if version is None else upsert(self.read(version), source, keys, update)
        return self.commit(state, mark)
