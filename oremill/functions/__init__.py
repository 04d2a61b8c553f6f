"""Column expressions.  All are built-in Spark functions, so they stay inside generated code."""

from oremill.functions.casts import clean_text, guarded_double, guarded_int, parse_date
from oremill.functions.clock import elapsed_minutes, hours_minutes_seconds, with_time_of_day
from oremill.functions.lineage import file_name, file_time, file_timestamp
from oremill.functions.messages import procedure_message, reconcile_message, run_message

__all__ = [
    "clean_text",
    "elapsed_minutes",
    "file_name",
    "file_time",
    "file_timestamp",
    "guarded_double",
    "guarded_int",
    "hours_minutes_seconds",
    "parse_date",
    "procedure_message",
    "reconcile_message",
    "run_message",
    "with_time_of_day",
]
