"""Compacted logs against whole ones; streaming dedup in waves against a plain rerun of its rules."""

from __future__ import annotations

import random
from collections import Counter
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oremill.operators import runlog
from oremill.schemas import CONTROL, declared
from oremill.sinks.compacted import CompactedLog
from oremill.streaming import dedup

CONTROL_LOG = CONTROL["task_control"]
BEGIN = datetime(2024, 1, 1)


def entries(spark, pick: random.Random, n: int, run: int):
    def row():
        at = BEGIN + timedelta(minutes=pick.randrange(500))
        known = {
            "job_name": f"j{pick.randrange(2)}", "task_name": f"t{pick.randrange(4)}", "parent_run_id": f"r{pick.randrange(3)}",
            "task_run_id": f"{run}-{pick.randrange(9)}", "status": pick.choice(["INITIATED", "COMPLETED", "FAILED"]),
            "filter_end_ts": pick.choice([at, None]), "execution_start_ts": at, "last_processed_file": pick.choice(["a.csv", "b.csv", None]),
        }
        return tuple(known.get(name) for name in CONTROL_LOG.names)

    return spark.createDataFrame([row() for _ in range(n)], CONTROL_LOG)


def states(log):
    found = runlog.watermark_per_task(log), runlog.last_file_per_task(log, F.col("job_name"))
    return [sorted(map(tuple, df.collect()), key=repr) for df in found]


def test_a_compacted_log_tells_what_the_whole_log_tells(spark, tmp_path):
    pick = random.Random(3)
    log = CompactedLog(spark, str(tmp_path / "log"), CONTROL_LOG, runlog.deciding_rows, every=3)
    assert log.read().count() == 0 and log.history().count() == 0
    total = 0
    for run in range(8):
        rows = entries(spark, pick, pick.choice([0, 1, 12]), run)
        total += rows.count()
        assert log.append(rows) == run + 1
        seen, whole = log.read(), log.history()
        assert whole.count() == total
        assert states(seen) == states(whole.drop("segment"))
        folders = {f.rsplit("/", 2)[-2] for f in seen.inputFiles()}
        assert len(folders) <= 3 and all(not f.startswith("segment") or int(f.split("=")[1]) > (run + 1) // 3 * 3 for f in folders)
    assert log.read().count() < total


def test_an_append_that_died_is_written_over(spark, tmp_path):
    path = tmp_path / "log"
    log = CompactedLog(spark, str(path), CONTROL_LOG, runlog.deciding_rows, every=2)
    log.append(entries(spark, random.Random(1), 4, 1))
    dead = path / "log" / "segment=2"
    entries(spark, random.Random(2), 50, 2).write.parquet(str(dead))
    (dead / "_SUCCESS").unlink()
    assert log.read().count() == log.history().count() == 4
    assert log.append(entries(spark, random.Random(4), 3, 2)) == 2
    assert log.history().count() == 7
    with pytest.raises(ValueError):
        CompactedLog(spark, str(path), CONTROL_LOG, runlog.deciding_rows, every=0)


SCHEMA = declared("key STRING, at STRING, note STRING, ingest_batch BIGINT")


def rerun(waves, delay):
    """What is accepted and late, wave by wave."""
    newest, until, accepted, late = None, {}, Counter(), Counter()
    for wave in waves:
        mark = newest - delay if newest else datetime.min
        until = {k: t for k, t in until.items() if t > mark}
        for key, at, _ in wave:
            if at is None or (at <= mark and key not in until):
                late[key, at] += 1
            elif at > mark and key not in until:
                until[key] = at + delay
                accepted[key] += 1
        newest = max([newest or datetime.min, *(at for _, at, _ in wave if at)])
    return accepted, late


def test_waves_with_late_and_repeated_rows(spark, tmp_path):
    pick, delay = random.Random(11), timedelta(minutes=10)
    waves = []
    for n in range(4):
        fresh = [(f"{n}-{i}", BEGIN + timedelta(minutes=60 * n + pick.randrange(50)), "new") for i in range(30)]
        # Copies in the wave, one early in the next wave, rows far behind, a NULL key, a row without a time.
        again = [pick.choice(fresh) for _ in range(10)]
        newest = max(at for _, at, _ in fresh)
        close = [(f"c{n}", newest, "x")] + ([(f"c{n - 1}", last, "x")] if n else [])
        far = [(f"late-{n}", BEGIN - timedelta(minutes=5), "x")] * 2 if n else []
        waves.append(fresh + again + close + far + [(None, newest, "x")] * 2 + [(f"none-{n}", None, "x")])
        last = newest
    source, target = str(tmp_path / "landed"), str(tmp_path / "out")
    at = F.try_to_timestamp("at")
    assert dedup.accept_new_rows(spark, source, SCHEMA, target, ["key"], at, "10 minutes") == (0, 0, 0)
    for n, wave in enumerate(waves):
        rows = [(k, t.isoformat(" ") if t else "no time", note) for k, t, note in wave]
        pick.shuffle(rows)
        spark.createDataFrame(rows, "key string, at string, note string").write.parquet(f"{source}/ingest_batch={n}")
        judged = dedup.accept_new_rows(spark, source, SCHEMA, target, ["key"], at, "10 minutes")
        accepted, late = rerun(waves[: n + 1], delay)
        assert Counter(r.key for r in dedup.accepted_rows(spark, target, SCHEMA).collect()) == accepted
        assert Counter((r.key, r.event_ts) for r in dedup.late_rows(spark, target, SCHEMA).collect()) == late
        assert sum(judged) == len(wave)
    assert dedup.accept_new_rows(spark, source, SCHEMA, target, ["key"], at, "10 minutes") == (0, 0, 0)
