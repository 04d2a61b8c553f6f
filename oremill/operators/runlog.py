"""Analytics over the task control log, for all jobs and tasks at once.

The log is append-only: a task's state is its latest row, and a state change is a new row.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oremill.functions import elapsed_minutes, hours_minutes_seconds, reconcile_message, run_message
from oremill.operators.dedup import latest_per_key, rank_within
from oremill.schemas import CONTROL
from oremill.sources.manifest import FIRST_WATERMARK

# The states of a task.
NOT_STARTED = "NOT STARTED"
INITIATED = "INITIATED"
COMPLETED = "COMPLETED"
FAILED = "FAILED"
FIRST_FILE_SUFFIX = "_19000101000000.csv"

TASK = ["job_name", "task_name"]
RUN = ["job_name", "parent_run_id"]


def active_tasks(metadata: DataFrame, job_name: str | None = None, grouping_id: str | None = None) -> DataFrame:
    """Distinct active metadata rows, optionally of one job and one group."""
    tasks = metadata.filter(F.upper(F.trim("is_active")) == "Y")
    if job_name is not None:
        tasks = tasks.filter(F.col("job_name") == job_name)
    if grouping_id:
        tasks = tasks.filter(F.col("grouping_id") == grouping_id)
    return tasks.distinct()


def watermark_per_task(log: DataFrame) -> DataFrame:
    """The newest ``filter_end_ts`` of each task's completed runs; 1900 for a task that never completed."""
    done = F.max(F.when(F.col("status") == COMPLETED, F.col("filter_end_ts")))
    return log.groupBy(*TASK).agg(F.coalesce(done, F.lit(FIRST_WATERMARK).cast("timestamp")).alias("watermark"))


def deciding_rows(log: DataFrame) -> DataFrame:
    """Of each task the rows that its watermark and its last file follow from, and its newest row: three at most.

    Picking again among picked and newer rows gives the same, so a log can be replaced by them up to any row.
    """
    row, done = F.struct(*log.columns), F.col("status") == COMPLETED
    newest = F.struct("execution_start_ts", "task_run_id", "last_processed_file")
    picked = [F.max_by(row, F.when(done, F.col("filter_end_ts"))), F.max_by(row, F.when(done, newest)), F.max_by(row, newest)]
    return log.groupBy(*TASK).agg(F.array_distinct(F.array_compact(F.array(*picked))).alias("_rows")).select(F.inline("_rows"))


def last_file_per_task(log: DataFrame, default_prefix: Column | None = None) -> DataFrame:
    """The file each task processed last, by its newest completed run.

    ``default_prefix`` names the source folder a task without one starts from, dated 1900.
    """
    done = F.col("status") == COMPLETED
    newest = F.max(F.when(done, F.struct("execution_start_ts", "task_run_id", "last_processed_file")))
    found = log.groupBy(*[F.trim(c).alias(c) for c in TASK]).agg(newest.alias("newest"))
    file = F.col("newest.last_processed_file")
    if default_prefix is not None:
        file = F.coalesce(file, F.concat(default_prefix, F.lit(FIRST_FILE_SUFFIX)))
    return found.select(*TASK, file.alias("last_processed_file"))


def run_rank(log: DataFrame) -> DataFrame:
    """Number the rows of each run, newest start first."""
    columns = [*RUN, "job_id", "task_name", "task_run_id", "status", "execution_start_ts"]
    return rank_within(log.select(*columns), RUN, "execution_start_ts", ["task_run_id"])


def restart_set(log: DataFrame, metadata: DataFrame | None = None) -> DataFrame:
    """Tasks to start again: failed in a run, and in it never not-started, initiated or completed.

    With ``metadata``, only tasks active there.  One aggregation stands in for the semi and anti join of the log
    with itself, so each log row is shuffled at most once, and a hot run is reduced before the shuffle.
    """
    tasks = log.groupBy(*RUN, "task_name").agg(
        F.bool_or(F.col("status") == FAILED).alias("failed"),
        F.bool_or(F.col("status").isin(NOT_STARTED, INITIATED, COMPLETED)).alias("other"),
    )
    failed = tasks.filter("failed AND NOT coalesce(other, false)").select(*RUN, "task_name")
    if metadata is None:
        return failed
    return failed.join(active_tasks(metadata).select(*TASK), TASK, "left_semi").select(*failed.columns)


def tasks_to_start(
    log: DataFrame, metadata: DataFrame, job_name: str, parent_run_id: str, grouping_id: str = ""
) -> DataFrame:
    """The metadata rows of the tasks one run has to start.

    A run without log rows, or without failures among its own tasks, starts all of its active tasks; after a failure
    only its restart set is started.
    """
    tasks = active_tasks(metadata, job_name, grouping_id)
    run = log.filter((F.col("job_name") == job_name) & (F.col("parent_run_id") == parent_run_id))
    own_failures = run.filter(F.col("status") == FAILED).join(tasks.select("task_name"), "task_name", "left_semi")
    after_failure = own_failures.agg((F.count(F.lit(1)) > 0).alias("failed")).scalar()
    again = restart_set(run).select("task_name", F.lit(True).alias("_again"))
    return tasks.join(again, "task_name", "left").filter(F.col("_again") | ~after_failure).select(*tasks.columns)


def not_started_rows(tasks: DataFrame, job_id: str, parent_run_id: str) -> DataFrame:
    """The log rows that announce tasks before they run."""
    known = {
        "job_name": F.col("job_name"), "job_id": F.lit(job_id), "parent_run_id": F.lit(parent_run_id),
        "task_name": F.col("task_name"), "status": F.lit(NOT_STARTED),
    }
    fields = CONTROL["task_control"].fields
    named = tasks.select("job_name", "task_name").distinct()
    return named.select(*[known.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name) for f in fields])


def reconcile(log: DataFrame) -> DataFrame:
    """Each load with its verdict: FAILED with a message where the counts differ (or one is missing)."""
    same = F.coalesce(F.col("source_count") == F.col("target_count"), F.lit(False))
    both_missing = F.col("source_count").isNull() & F.col("target_count").isNull()
    status = F.when(same | both_missing, F.lit(COMPLETED)).otherwise(F.lit(FAILED))
    return log.withColumn("load_status", status).withColumn(
        "load_message", reconcile_message(F.col("task_name"), F.col("load_status"))
    )


def reconcile_summary(log: DataFrame) -> DataFrame:
    """Loads and mismatches per job."""
    return reconcile(log).groupBy("job_name").agg(
        F.count(F.lit(1)).alias("loads"),
        F.count_if(F.col("load_status") == FAILED).alias("failed_loads"),
        F.sum("source_count").alias("source_rows"),
        F.sum("target_count").alias("target_rows"),
    )


def task_state_latest(log: DataFrame) -> DataFrame:
    """The current row of each task of each run."""
    return latest_per_key(log, [*RUN, "task_name"], ["execution_start_ts"], ["task_run_id"])


def as_run_log(rows: DataFrame, values: dict[str, Column]) -> DataFrame:
    """Rows in the declared form of the run log; columns without a value are NULL."""
    fields = CONTROL["task_run_log"].fields
    return rows.select(
        *[values.get(f.name, F.lit(None)).cast(f.dataType.simpleString()).alias(f.name) for f in fields]
    )


def run_log_rows(log: DataFrame, at: Column | None = None) -> DataFrame:
    """Run-log rows for finished loads: the message with its class, and the counts in and out."""
    return as_run_log(reconcile(log), {
        "job_id": F.col("job_id"), "parent_run_id": F.col("parent_run_id"), "task_run_id": F.col("task_run_id"),
        "create_dt": F.current_timestamp() if at is None else at,
        "primary_message": run_message(F.col("load_status"), F.col("load_message")),
        "records_in": F.col("source_count"), "records_out": F.col("target_count"),
    })


def run_report(log: DataFrame) -> DataFrame:
    """Per job: message classes, rows in and out, and how long its tasks took."""
    seconds = F.unix_micros("execution_end_ts") - F.unix_micros("execution_start_ts")
    per_job = reconcile(log).groupBy("job_name").agg(
        F.count_if(F.col("load_status") == COMPLETED).alias("info_rows"),
        F.count_if(F.col("load_status") == FAILED).alias("critical_rows"),
        F.sum("source_count").alias("records_in"),
        F.sum("target_count").alias("records_out"),
        F.sum(seconds).alias("_micros"),
        F.max(elapsed_minutes(F.col("execution_start_ts"), F.col("execution_end_ts"))).alias("longest_minutes"),
    )
    total = hours_minutes_seconds(F.col("_micros") / 1000)
    return per_job.withColumn("_total", total).select(
        "job_name", "info_rows", "critical_rows", "records_in", "records_out", "longest_minutes",
        F.col("_total.hours").alias("total_hours"), F.col("_total.minutes").alias("total_minutes"),
        F.col("_total.seconds").alias("total_seconds"),
    )


def retention_filter(df: DataFrame, at: Column, column: str, months: int = 6) -> DataFrame:
    """Rows no older than ``months`` of 30 days; on a table partitioned by date old partitions are not read."""
    return df.filter(F.col(column) >= at - F.make_dt_interval(F.lit(months * 30)))
