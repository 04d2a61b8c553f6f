"""Durations and time-of-day helpers, as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def elapsed_minutes(start: Column, end: Column) -> Column:
    """Minutes between two timestamps, to two decimals."""
    micros = F.unix_micros(end) - F.unix_micros(start)
    return F.round(micros / F.lit(60_000_000.0), 2)


def hours_minutes_seconds(millis: Column) -> Column:
    """A struct (hours, minutes, seconds) of a non-negative number of milliseconds, rounded down."""
    seconds = F.floor(millis / 1000).cast("long")
    return F.struct(
        F.floor(seconds / 3600).cast("long").alias("hours"),
        F.floor(F.pmod(seconds, F.lit(3600)) / 60).cast("long").alias("minutes"),
        F.pmod(seconds, F.lit(60)).cast("long").alias("seconds"),
    )


def with_time_of_day(day: Column, moment: Column | None = None) -> Column:
    """The date part of a text, followed by the time of day of ``moment`` (default: now)."""
    at = F.current_timestamp() if moment is None else moment
    return F.concat(F.substring(day, 1, 10), F.date_format(at, " HH:mm:ss.SSSSSS"))
