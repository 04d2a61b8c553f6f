"""As-of joins: to each row the last event of its key that is not later, from one sort over both.

Rows and events are put together, sorted over all tasks by key and time, and stored with the partition of the sort.  Within
a partition the last event is carried forward; what a partition starts with is the last event of its key in an earlier one,
and that is found among one row for each key and partition.  So a key may have any number of rows and events and fill any
number of partitions, and no row is compared with a range of events.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from oremill.sinks.loads import materialize

_EVENT, _ROW = 0, 1


def asof_join(rows: DataFrame, events: DataFrame, keys: list[str], time: str, event_time: str, ties: list[str], event: str = "event") -> DataFrame:
    """``rows`` with one more column ``event``, a struct of the event's columns: the last event of the row's key whose
    ``event_time`` is not after the row's ``time``; NULL if there is none.

    Of events at the same time the last by ``ties`` counts; they should tell events of a key and time apart.  A row and an
    event at the same time match.  NULL keys match NULL keys; a row without a time has no event, and an event without one
    is none.  Every row comes once, and rows that are equal stay as often as they are there.
    """
    fields = F.struct(*[F.col(c) for c in events.columns]).alias("_event")
    kinds = events.select(fields).schema["_event"].dataType
    both = (
        rows.select(*[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col(time).cast("timestamp").alias("_time"), F.lit(_ROW).alias("_kind"),
                    F.struct(*rows.columns).alias("_row"), F.lit(None).cast(kinds).alias("_event"))
        .unionByName(events.filter(F.col(event_time).isNotNull()).select(
            *[F.col(k).alias(f"_k{n}") for n, k in enumerate(keys)], F.col(event_time).cast("timestamp").alias("_time"), F.lit(_EVENT).alias("_kind"),
            F.lit(None).cast(rows.select(F.struct(*rows.columns).alias("r")).schema["r"].dataType).alias("_row"), fields))
    )
    named = [f"_k{n}" for n in range(len(keys))]
    order = [F.col(k).asc_nulls_first() for k in named]
    tie = [F.col(f"_event.{c}").asc_nulls_first() for c in ties]
    at = [F.col("_time").asc_nulls_first(), F.col("_kind").asc(), *tie]
    # Ties of a hash keep equal keys and times from having to be in one partition.
    spread = F.xxhash64("_row").alias("_spread")
    ordered = both.select("*", spread).repartitionByRange(*order, *at, F.col("_spread"))
    placed = materialize(ordered.withColumn("_part", F.spark_partition_id()), "asof")

    within = Window.partitionBy("_part", *named).orderBy(*at).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    carried = placed.withColumn("_near", F.last("_event", ignorenulls=True).over(within))
    # One row for each key and partition of the sort.
    last = placed.filter(F.col("_kind") == _EVENT).groupBy("_part", *named).agg(
        F.max_by("_event", F.struct("_time", *[F.col(f"_event.{c}") for c in ties])).alias("_end")
    )
    starts = _with_ends(placed, last, named)
    earlier = Window.partitionBy(*named).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    before = materialize(starts.withColumn("_before", F.last("_end", ignorenulls=True).over(earlier)).drop("_end"), "asof-starts")
    match = [F.col("_part") == F.col("_at"), *[F.col(k).eqNullSafe(F.col(f"{k}_at")) for k in named]]
    before = before.select(F.col("_part").alias("_at"), *[F.col(k).alias(f"{k}_at") for k in named], "_before")
    found = carried.filter(F.col("_kind") == _ROW).join(before, match, "left")
    near = F.when(F.col("_time").isNotNull(), F.coalesce("_near", "_before")).alias(event)
    return found.select("_row.*", near)


def _with_ends(placed: DataFrame, last: DataFrame, named: list[str]) -> DataFrame:
    """Each key and partition that there is, with its last event there."""
    there = placed.select("_part", *named).distinct()
    ends = last.select(F.col("_part").alias("_p"), *[F.col(k).alias(f"{k}_e") for k in named], "_end")
    match = [F.col("_part") == F.col("_p"), *[F.col(k).eqNullSafe(F.col(f"{k}_e")) for k in named]]
    return there.join(ends, match, "left").select("_part", *named, "_end")


def attribute_files(files: DataFrame, runs: DataFrame) -> DataFrame:
    """Each file with the run that its time falls in: ``task_run_id`` and ``in_run``.

    ``files`` has ``job_name, task_name, path, modified``; ``runs`` has ``job_name, task_name, task_run_id,
    execution_start_ts, execution_end_ts``.  It is the last run of the task that had started by then, of two that started
    together the one with the larger id.  ``in_run`` tells whether it was still running, its end included, a run without an
    end counting as running; a file between runs has ``in_run`` false, one before the first run has no run.
    """
    window = runs.select("job_name", "task_name", "task_run_id", "execution_start_ts", "execution_end_ts")
    found = asof_join(files, window, ["job_name", "task_name"], "modified", "execution_start_ts", ["task_run_id"], "run")
    end = F.col("run.execution_end_ts")
    inside = F.when(F.col("run").isNotNull(), end.isNull() | (end >= F.col("modified").cast("timestamp")))
    return found.select(*files.columns, F.col("run.task_run_id").alias("task_run_id"), F.coalesce(inside, F.lit(False)).alias("in_run"))
