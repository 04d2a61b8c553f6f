"""Versioned tables in parts: a commit writes only the parts that it changes, and notes what it changed.

A table is dealt into folders, by a hash of its key or by a column of its own such as a day.  A version's log row lists, for
every part, the versions whose folders make it up.  A commit that replaces rows writes their parts anew; one that only adds
rows to a part adds a folder and leaves the stored ones alone.  All others stay as they are, unread and unwritten.

Beside each version stand its changes, rows with a sign: -1 for a row that went, 1 for one that came.  A table derived from
this one reads those, and not the table, to follow it.
"""

from __future__ import annotations

import json
from collections.abc import Iterable
from datetime import datetime, timezone

from pyspark.sql import Column, DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oremill.operators.retract import SIGN, net, signed
from oremill.operators.upsert import key_violations, matching, upsert
from oremill.schemas import declared
from oremill.sinks.loads import materialize, overwrite
from oremill.sinks.versions import LOG as PLAIN_LOG
from oremill.sinks.versions import VersionedTable

# Folders are named by these; no column of a table may be.
BUCKET, VERSION = "key_bucket", "table_version"
_PART, _HASH = "changed_part", "_key_hash"
#: How Spark names the folder of a NULL.
NULL_PART = "__HIVE_DEFAULT_PARTITION__"
#: A part of more folders than this is written as one when rows are added to it.
MOST_FOLDERS = 8

PARTS = T.ArrayType(
    T.StructType([*declared("part STRING").fields, T.StructField("versions", T.ArrayType(T.IntegerType())), *declared("part_rows BIGINT").fields])
)
LOG = T.StructType([*PLAIN_LOG.fields, *declared("columns STRING").fields, *declared("whole_since INT").fields, T.StructField("parts", PARTS)])


class KeyedTable(VersionedTable):
    """A versioned table with one row per key.

    Without ``by`` rows are dealt into ``buckets`` folders by a hash of ``keys``; else by the values of the column ``by``, a
    date or a whole number.  ``noted`` are the columns kept in the changes (default: all).  ``sorted_by`` sorts rows within
    files, so that a filter on the column skips most of their pages.
    """

    LOG = LOG

    def __init__(
        self, spark: SparkSession, path: str, keys: list[str], buckets: int = 64, by: str | None = None,
        noted: list[str] | None = None, sorted_by: str | None = None,
    ):
        super().__init__(spark, path)
        self.keys, self.buckets, self.by, self.noted, self.sorted_by = keys, buckets, by or BUCKET, noted, sorted_by
        #: Log rows read so far: a version's row never changes.
        self._known: dict[int, Row] = {}
        #: Whether only this object writes the table for now, so that its newest version need not be looked up again.
        self.alone = False

    def part(self) -> Column:
        """The part of a row as text."""
        if self.by == BUCKET:
            return F.pmod(F.xxhash64(*self.keys), F.lit(self.buckets)).cast("string")
        return F.coalesce(F.col(self.by).cast("string"), F.lit(NULL_PART))

    def parts_of(self, rows: DataFrame) -> list[str]:
        """The parts that rows fall in: at most as many as the table may have."""
        return sorted(r["part"] for r in rows.select(self.part().alias("part")).distinct().collect())

    def commit_of(self, version: int) -> Row | None:
        """The log row of a version."""
        if version not in self._known:
            found = self.history().filter(F.col("version") == version).limit(1).collect()
            self._known.update({version: row for row in found})
        return self._known.get(version)

    def latest(self) -> Row | None:
        if not (self.alone and self._known):
            newest = self.history().agg(F.max_by(F.struct(*self.LOG.names), "version").alias("commit")).first()["commit"]
            if newest is None:
                return None
            self._known[newest["version"]] = newest
        return self._known[max(self._known)]

    def read(self, version: int | None = None, of: Iterable[str] | None = None) -> DataFrame:
        """The current state, or the state as of ``version``; with ``of`` only those parts, and no file of any other."""
        commit = self.latest() if version is None else self.commit_of(version)
        if commit is None:
            raise LookupError(f"{self.path} has no committed version" + (f" {version}" if version else ""))
        return self._state(commit, of)

    def _state(self, commit: Row, of: Iterable[str] | None = None) -> DataFrame:
        schema = T.StructType.fromJson(json.loads(commit["columns"]))
        wanted = None if of is None else set(of)
        live = [p for p in commit["parts"] if wanted is None or p["part"] in wanted]
        paths = [f"{self.path}/{VERSION}={v}/{self.by}={p['part']}" for p in live for v in p["versions"]]
        if not paths:
            return self.spark.createDataFrame([], schema)
        stored = T.StructType([*schema.fields, T.StructField(VERSION, T.IntegerType())])
        if self.by == BUCKET:
            stored = stored.add(BUCKET, T.IntegerType())
        return self.spark.read.schema(stored).option("basePath", self.path).parquet(*paths).select(*schema.names)

    def commit(self, df: DataFrame, mark: str | None = None) -> int:
        """Store ``df`` as the whole of the next version."""
        number = (self.current() or 0) + 1
        counts = self._write(df, number)
        live = [(part, [number], rows) for part, rows in counts.items()]
        return self._log(number, df.schema, live, mark, whole_since=number)

    def _write(self, df: DataFrame, number: int) -> dict[str, int]:
        """Write a folder for each part of ``df``, dealt anew so that a part is few files; rows by part."""
        columns = df if self.by != BUCKET else df.withColumn(BUCKET, self.part().cast("int"))
        spread = columns.hint("rebalance", F.col(self.by))
        if self.sorted_by:
            spread = spread.sortWithinPartitions(self.by, self.sorted_by)
        place = f"{self.path}/{VERSION}={number}"
        spread.write.mode("overwrite").partitionBy(self.by).parquet(place)
        written = self.spark.read.schema(columns.schema).parquet(place)
        part = F.coalesce(F.col(self.by).cast("string"), F.lit(NULL_PART)).alias("part")
        return {r["part"]: r["count"] for r in written.groupBy(part).count().collect()}

    def _log(self, number: int, schema: T.StructType, live: list[tuple], mark: str | None, whole_since: int) -> int:
        entry = (number, sum(rows for _, _, rows in live), mark, datetime.now(timezone.utc), schema.json(), whole_since, sorted(live))
        rows = self.spark.createDataFrame([entry], self.LOG)
        rows.coalesce(1).write.mode("append").parquet(f"{self.path}/log")
        parts = [Row(part=part, versions=versions, part_rows=count) for part, versions, count in entry[-1]]
        self._known[number] = Row(**dict(zip(self.LOG.names, (*entry[:-1], parts), strict=True)))
        return number

    def _notes(self, number: int) -> str:
        return f"{self.path}/changes/v={number}"

    def rewrite(self, touched: Iterable[str], rows: DataFrame, changes: DataFrame, mark: str | None = None, added: Iterable[str] = ()) -> int:
        """The next version: ``rows`` are all there is of the parts ``touched``, and come to what the parts ``added`` hold.

        ``rows`` may be computed from those parts of the version before.  ``changes`` are signed rows.
        """
        before = self.latest()
        overwrite(changes, self._notes(before["version"] + 1))
        return self._advance(before, set(touched), rows, mark, set(added))

    def _advance(self, before: Row, anew: set[str], rows: DataFrame, mark: str | None, added: set[str]) -> int:
        schema, number = T.StructType.fromJson(json.loads(before["columns"])), before["version"] + 1
        counts = self._write(rows.select(*schema.names), number)
        live = {p["part"]: (p["versions"], p["part_rows"]) for p in before["parts"] if p["part"] not in anew}
        for part, rows_of_part in counts.items():
            if part not in anew | added:
                raise ValueError(f"{self.path}: rows of the part {part}, which is not among those to be written")
            versions, held = live.get(part, ([], 0))
            live[part] = ([*versions, number], held + rows_of_part)
        return self._log(number, schema, [(part, *of) for part, of in live.items()], mark, before["whole_since"])

    def _recurring(self, state: DataFrame, keys: DataFrame) -> DataFrame:
        """The stored rows of ``keys``.  Hashes of keys are compared first, so that rows whose key is not among them are not
        shuffled with all their columns."""
        hashed = F.xxhash64(*self.keys).alias(_HASH)
        again = materialize(state.select(hashed).join(keys.select(hashed).distinct(), _HASH, "left_semi").distinct(), "recurring")
        some = state.withColumn(_HASH, F.xxhash64(*self.keys)).join(again, _HASH, "left_semi").drop(_HASH)
        return matching(some, keys, "left_semi")

    def replace(
        self, keys: DataFrame, rows: DataFrame, mark: str | None = None, touched: list[str] | None = None, gone: DataFrame | None = None,
    ) -> int:
        """The next version: stored rows of ``keys`` go, ``rows``, which are of those keys alone, come.  A NULL key is a key.

        Both are read several times, so pass stored ones; ``touched`` are the parts of the keys, and ``gone`` the stored rows
        of the keys, if they are known.  Of these parts only the columns of the key and of the notes are read, unless a row of
        the part goes: then the part is written anew.
        """
        if self.by != BUCKET:
            raise ValueError("only a table dealt by its key can be told by keys alone which parts they are in")
        before, keys = self.latest(), keys.select(*self.keys)
        touched = self.parts_of(keys) if touched is None else touched
        noted = self.noted or T.StructType.fromJson(json.loads(before["columns"])).names
        columns = [*dict.fromkeys([*self.keys, *noted])]
        if gone is None:
            gone = self._recurring(self._state(before, touched).select(*columns), keys)
        gone = gone.select(*columns)
        part = self.part().alias(_PART)
        changes, notes = signed(gone, rows.select(*columns)).select(SIGN, *noted, part), self._notes(before["version"] + 1)
        overwrite(changes, notes)
        lost = self.spark.read.schema(changes.schema).parquet(notes).filter(F.col(SIGN) < 0).select(_PART).distinct()
        many = {p["part"] for p in before["parts"] if len(p["versions"]) >= MOST_FOLDERS}
        anew = {*(r[_PART] for r in lost.collect()), *(many & set(touched))}
        state = rows
        if anew:
            state = matching(self._state(before, anew), keys, "left_anti").unionByName(rows)
        return self._advance(before, anew, state, mark, set(touched))

    def upsert(self, source: DataFrame, keys: list[str] | None = None, update: list[str] | None = None, mark: str | None = None) -> int:
        """Upsert ``source`` by the table's key: only parts in which a stored row is matched are written anew.

        Repeated or NULL keys are refused; the first commit stores the source as it is.
        """
        if keys is not None and list(keys) != self.keys:
            raise ValueError(f"{self.path} is dealt by {self.keys}, not by {keys}")
        source = materialize(source, "upsert-source")
        broken = key_violations(source, self.keys).limit(3).collect()
        if broken:
            raise ValueError(f"upsert source has repeated or NULL keys, e.g. {[r.asDict() for r in broken]}")
        if self.current() is None:
            return self.commit(source, mark)
        rows = source
        if update is not None:
            # Columns that a match leaves alone come from the rows that go.
            old = matching(self.read(of=self.parts_of(source)), source.select(*self.keys), "left_semi")
            rows = materialize(upsert(old, source, self.keys, update), "upsert-rows")
        return self.replace(rows, rows, mark)

    def changes(self, since: int, now: int) -> DataFrame | None:
        """What changed from one version to a later one, as signed rows of the noted columns, with what came and went again
        cancelled; None if the table was stored as a whole in between."""
        commit = self.commit_of(now)
        if commit["whole_since"] > since:
            return None
        schema = T.StructType.fromJson(json.loads(commit["columns"]))
        noted = T.StructType([f for name in self.noted or schema.names for f in schema.fields if f.name == name])
        columns = T.StructType([T.StructField(SIGN, T.LongType()), *noted.fields])
        if since == now:
            return self.spark.createDataFrame([], columns)
        return net(self.spark.read.schema(columns).parquet(*[self._notes(v) for v in range(since + 1, now + 1)]))
