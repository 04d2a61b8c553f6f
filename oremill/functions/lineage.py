"""Where a row came from, read off its file path."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PATH_COMPONENTS_KEPT = 4


def file_name(path: Column) -> Column:
    """The last four components of a path, or the whole path where it has fewer."""
    return F.substring_index(path, "/", -PATH_COMPONENTS_KEPT)


def file_timestamp(path: Column) -> Column:
    """The text between the last ``_`` and the extension of the file's own name; NULL where there is none.

    Taken per row of a file, so by plain search: a pattern costs as much as parsing the row.
    """
    name = F.substring_index(path, "/", -1)
    dots = F.length(name) - F.length(F.replace(name, F.lit(".")))
    stem = F.call_function("substring_index", name, F.lit("."), dots)
    found = name.contains(".") & stem.contains("_")
    return F.when(found, F.nullif(F.substring_index(stem, "_", -1), F.lit("")))


# The forms that the time in a file's name may have, the longest first.
FILE_TIME_FORMATS = ("yyyyMMddHHmmss", "yyyyMMdd")


def file_time(text: Column, formats: tuple[str, ...] = FILE_TIME_FORMATS) -> Column:
    """The time that a file's timestamp text stands for, in the first form that it has; NULL where it has none."""
    return F.coalesce(*[F.try_to_timestamp(F.when(F.length(text) == len(form), text), F.lit(form)) for form in formats])
