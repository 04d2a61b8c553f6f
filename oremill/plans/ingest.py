"""Metadata-driven file ingest: pick files, read them once, load them, and log what happened."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.config import IngestSpec, is_yes
from oremill.functions import file_name, file_timestamp
from oremill.functions.messages import files_message, reconcile_message, run_message
from oremill.operators.runlog import COMPLETED, FAILED, INITIATED, as_run_log, not_started_rows, watermark_per_task
from oremill.schemas import CONTROL
from oremill.sinks.loads import LOAD_FROM, append, ensure, load, materialize, replace_partitions
from oremill.sources.delimited import null_option, skip_leading_rows
from oremill.sources.manifest import file_manifest, files_after, latest_file


@dataclass(frozen=True)
class RunIds:
    job_id: str
    parent_run_id: str
    task_run_id: str


# The kinds of metadata rows that ingest files.
FILE_TASKS = ("ADLS_TO_RAW", "ADLS_TO_REFINED", "ADLS_TO_CONSUMED")


def task_specs(tasks: DataFrame, root: str) -> list[IngestSpec]:
    """The specs of the file-ingest tasks among the metadata rows one run has to start: the few tasks of a job."""
    rows = tasks.filter(F.upper("transformation_type").isin(*FILE_TASKS)).orderBy("task_name").toLocalIterator()
    return [IngestSpec.from_metadata(row, root) for row in rows if not is_yes(row["execute_child_notebook"])]


def announce(tasks: DataFrame, log_path: str, job_id: str, parent_run_id: str) -> None:
    """Note the tasks that a run is about to start as NOT STARTED in its control log."""
    ensure(tasks.sparkSession, f"{log_path}/task_control", CONTROL["task_control"])
    append(not_started_rows(tasks, job_id, parent_run_id), f"{log_path}/task_control")


def task_watermark(log: DataFrame, spec: IngestSpec) -> datetime | None:
    """The newest completed ``filter_end_ts`` of one task, one value; None before its first run."""
    own = log.filter((F.col("job_name") == spec.job_name) & (F.col("task_name") == spec.task_name))
    row = watermark_per_task(own).first()
    return row["watermark"] if row else None


def _utc(moment: datetime) -> str:
    return moment.astimezone(timezone.utc).strftime("%Y-%m-%dT%H:%M:%S.%fZ")


def scan_files(
    spark: SparkSession,
    spec: IngestSpec,
    after: datetime | None = None,
    until: datetime | None = None,
    path: str | None = None,
) -> DataFrame:
    """The files of a task changed in ``(after, until]``, as one scan with lineage columns.

    The reader's own ``modifiedAfter``/``modifiedBefore`` choose the files while listing, so no list of names goes
    through this code and each file is read once, however many there are.  File times are whole milliseconds; one
    is added to ``until`` as ``modifiedBefore`` leaves its bound out.
    """
    reader = (
        spark.read.format(spec.file_format)
        .options(header=spec.header, sep=spec.delimiter, inferSchema=False, escape='"')
        .options(ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False, recursiveFileLookup=True)
        .options(**null_option(spec.null_value), **spec.options)
    )
    if after is not None:
        reader = reader.option("modifiedAfter", _utc(after))
    if until is not None:
        reader = reader.option("modifiedBefore", _utc(until + timedelta(milliseconds=1)))
    scan = skip_leading_rows(reader.load(path or spec.source_path), spec.skip_rows, keep=("file_path",))
    origin = F.col("file_path")
    return scan.withColumns({"FILE_NAME": file_name(origin), "FILE_TS": file_timestamp(origin)}).drop("file_path")


def run_ingest(spark: SparkSession, spec: IngestSpec, log_path: str, ids: RunIds, now: datetime | None = None) -> str:
    """Run one task: ingest its new files, append its state and message to the logs; returns the final status.

    ``log_path`` holds ``task_control``, ``task_run_log`` and ``file_log``.  A failure is logged and raised again.

    Rows and files are stored under the watermark that the run started from.  A run that died, wherever, has not moved the
    watermark, so the next run replaces whatever it left: each file counts once.
    """
    started = now or datetime.now(timezone.utc)
    started = started.replace(microsecond=started.microsecond // 1000 * 1000)
    watermark = task_watermark(ensure(spark, f"{log_path}/task_control", CONTROL["task_control"]), spec)
    control = {
        "job_name": spec.job_name, "job_id": ids.job_id, "parent_run_id": ids.parent_run_id,
        "task_name": spec.task_name, "task_run_id": ids.task_run_id, "filter_start_ts": watermark,
        "filter_end_ts": started, "execution_start_ts": started,
    }
    _log_state(spark, log_path, {**control, "status": INITIATED})
    try:
        files = file_manifest(spark, spec.source_path).filter(F.col("modified") <= F.lit(started))
        if watermark is not None and spec.all_files:
            files = files_after(files, F.lit(watermark))
        if spec.latest_only and not spec.all_files:
            files = files.join(latest_file(files).select("path"), "path", "left_semi").select(*files.columns)
        files = materialize(files, "new-files")
        last_file = F.max(F.struct("modified", "name", "path"))
        taken = files.agg(F.count(F.lit(1)).alias("files"), last_file.alias("last")).first()
        counts = (None, None)
        if taken["files"]:
            if spec.all_files:
                scan = scan_files(spark, spec, after=watermark, until=started)
            else:
                scan = scan_files(spark, spec, path=taken["last"]["path"] if spec.latest_only else None)
            # A task with a log but no completed run has the first watermark, of 1900.
            mark = "first" if watermark is None or watermark.year <= 1900 else f"after-{watermark:%Y%m%d-%H%M%S-%f}"
            result = load(scan, spec.target_path, spec.load_type, task_name=spec.task_name, load_from=mark)
            counts = (result.source_count, result.target_count)
            noted = {"task_run_id": ids.task_run_id, "job_name": spec.job_name, "task_name": spec.task_name, LOAD_FROM: mark}
            rows = files.select("path", "name", "size", "modified", *[F.lit(v).alias(k) for k, v in noted.items()])
            replace_partitions(rows, f"{log_path}/file_log", ["job_name", "task_name", LOAD_FROM])
        status = COMPLETED if counts[0] == counts[1] else FAILED
        last = taken["last"]["name"] if taken["files"] else None
        _log_state(spark, log_path, {
            **control, "execution_end_ts": datetime.now(timezone.utc), "source_count": counts[0],
            "target_count": counts[1], "status": status, "last_processed_file": last,
        })
        text = F.concat(
            reconcile_message(F.lit(spec.task_name), F.lit(status)), F.lit(",  "), files_message(F.lit(taken["files"]))
        )
        _log_message(spark, log_path, ids, run_message(F.lit(status), text), counts)
        return status
    except Exception as error:
        _log_state(spark, log_path, {**control, "execution_end_ts": datetime.now(timezone.utc), "status": FAILED})
        text = F.lit(f"{spec.task_name} - {FAILED} {error}")
        _log_message(spark, log_path, ids, run_message(F.lit(FAILED), text), (None, None))
        raise


def _log_state(spark: SparkSession, log_path: str, values: dict) -> None:
    schema = CONTROL["task_control"]
    row = spark.createDataFrame([tuple(values.get(name) for name in schema.names)], schema)
    append(row.coalesce(1), f"{log_path}/task_control")


def _log_message(spark: SparkSession, log_path: str, ids: RunIds, message: Column, counts: tuple) -> None:
    known = {
        "job_id": F.lit(ids.job_id), "parent_run_id": F.lit(ids.parent_run_id), "task_run_id": F.lit(ids.task_run_id),
        "create_dt": F.current_timestamp(), "primary_message": message,
        "records_in": F.lit(counts[0]), "records_out": F.lit(counts[1]),
    }
    append(as_run_log(spark.range(1).coalesce(1), known), f"{log_path}/task_run_log")
