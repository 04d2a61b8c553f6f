"""Text cleaning and casts that give NULL, never an error, for malformed input (ANSI mode included)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# What counts as a well-formed number.  No sign, no blanks, no exponent.
INTEGER_PATTERN = r"^[0-9]+$"
DECIMAL_PATTERN = r"^[0-9]+(\.[0-9]+)?$"


def _as_column(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def guarded_int(value: Column | str) -> Column:
    """INT if the text is all digits and fits, else NULL."""
    text = _as_column(value)
    return F.when(text.rlike(INTEGER_PATTERN), text.try_cast("int"))


def guarded_double(value: Column | str) -> Column:
    """DOUBLE if the text is an unsigned decimal, else NULL."""
    text = _as_column(value)
    return F.when(text.rlike(DECIMAL_PATTERN), text.try_cast("double"))


def parse_date(value: Column | str, fmt: str | None = None) -> Column:
    """DATE, or NULL where the text is not one."""
    return F.try_to_date(_as_column(value), fmt)


def clean_text(value: Column | str) -> Column:
    """Trimmed and upper-cased, the form codes are compared in."""
    return F.upper(F.trim(_as_column(value)))
