"""Texts written to the run log."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Texts that readers of the run log match on.
MISMATCH_TEXT = "source and target counts are not matching!"
NO_FILES_TEXT = "No files available to process for the day"
FILES_SUFFIX = " files are processed"


def reconcile_message(task_name: Column, status: Column) -> Column:
    """One line on a load: the task, its status, and the mismatch where there is one."""
    line = F.concat(task_name, F.lit(" - "), status)
    return F.when(status == "FAILED", F.concat(line, F.lit(f" {MISMATCH_TEXT}"))).otherwise(line)


def run_message(status: Column, text: Column) -> Column:
    """The message with its class in front: CRITICAL for a failed run, INFO otherwise."""
    return F.concat(F.when(status == "FAILED", F.lit("CRITICAL:")).otherwise(F.lit("INFO:")), text)


def files_message(count: Column) -> Column:
    """What a load says about the number of files it took; their names are rows of the file log."""
    return F.when(count > 0, F.concat(count.cast("string"), F.lit(FILES_SUFFIX))).otherwise(F.lit(NO_FILES_TEXT))


def procedure_message(
    log_type: Column,
    message: Column,
    procedure: Column,
    sequence: Column,
    action: Column,
    table: Column,
    row_count: Column,
    minutes: Column,
) -> Column:
    """Progress, success or failure text of one step of a procedure.

    A message already given is kept for progress and success; a failure always names the step.
    """
    kind = F.lower(F.trim(log_type))
    # The wording, blanks included.
    progress = F.concat(
        F.lit("Sql_seq: "), sequence.cast("string"), F.lit(", No of records "), action, F.lit(" in the  "), table,
        F.lit(" table is "), row_count.cast("string"),
    )
    success = F.concat(F.lit("Success.Minutes to execute  sp: "), minutes.cast("decimal(18,2)").cast("string"))
    failure = F.concat(
        F.lit("Procedure Failed : "), procedure, F.lit(" at the transaction no : "), sequence.cast("string"),
        F.lit(", while doing  "), action, F.lit(" for the table "), table, F.lit(",  Error_description : "), message,
    )
    given = F.trim(message) != ""
    return (
        F.when(kind == "fail", failure)
        .when(given, message)
        .when(kind == "progress", progress)
        .when(kind == "success", success)
        .otherwise(message)
    )
