from __future__ import annotations

import re
from datetime import date, datetime

from pyspark.sql import functions as F

from oremill.functions import (
    clean_text,
    elapsed_minutes,
    file_name,
    file_timestamp,
    guarded_double,
    guarded_int,
    hours_minutes_seconds,
    parse_date,
    procedure_message,
    with_time_of_day,
)


def evaluate(spark, values, build, kind="STRING"):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i INT, v {kind}")
    return [r["x"] for r in df.select("i", build(F.col("v")).alias("x")).orderBy("i").collect()]


def test_guarded_int(spark):
    # The pattern's end also matches before a final line break, and the cast trims it.
    values = ["12", "007", "2147483647", "2147483648", "99999999999", " 7", "-3", "+3", "1.0", "", None, "two", "12\n"]
    assert evaluate(spark, values, guarded_int) == [12, 7, 2147483647] + [None] * 9 + [12]


def test_guarded_double(spark):
    values = ["12", "12.50", "1.2.3", ".5", "5.", "-1.0", "1e3", "N/A", "", None, "0.1"]
    assert evaluate(spark, values, guarded_double) == [12.0, 12.5] + [None] * 8 + [0.1]


def test_parse_date(spark):
    values = ["2024-02-29", "2023-02-29", "not-a-date", "", None, "2024-01-15 10:00:00"]
    expected = [date(2024, 2, 29), None, None, None, None, date(2024, 1, 15)]
    assert evaluate(spark, values, parse_date) == expected
    assert evaluate(spark, ["15/01/2024", "x"], lambda c: parse_date(c, "dd/MM/yyyy")) == [date(2024, 1, 15), None]


def test_clean_text(spark):
    assert evaluate(spark, ["  cancelled ", "Ok", "", None], clean_text) == ["CANCELLED", "OK", "", None]


def test_file_lineage(spark):
    paths = [
        "/vol/landing/retail/orders/Orders_20240101.csv", "/a/Plain.csv", "x/y_z/Plain.csv", "Orders_a_20240102.csv.gz",
        None,
    ]
    assert evaluate(spark, paths, file_name) == [
        "landing/retail/orders/Orders_20240101.csv", "/a/Plain.csv", "x/y_z/Plain.csv", "Orders_a_20240102.csv.gz",
        None,
    ]
    assert evaluate(spark, paths, file_timestamp) == ["20240101", None, None, "20240102.csv", None]


def test_file_lineage_is_that_of_patterns_without_a_pattern(spark):
    """Paths of all shapes against the patterns that once took them apart; these cost as much as parsing a row."""
    paths = ["", "/", "a", ".", "_", "_.", "a_.csv", "_b.c", "a.b_c", "a_b.c_d", "a_b.c.d", "a__b.c", "a_b_.c", "a_b/c.d", "a.b/c_d", "/a/b/c/d", "a/b/c/d/", "//a_1.x", "é_ü.ö", "a_b.", "x_y/.z_1", "file:/r/n_a/o/part-0_1-c000.csv.gz", None]
    found = list(zip(evaluate(spark, paths, file_name), evaluate(spark, paths, file_timestamp), strict=True))
    for path, (name, time) in zip(paths, found, strict=True):
        match = None if path is None else re.search(r"_([^_/]*)[.][^./]*$", path)
        assert name == (None if path is None else "/".join(path.split("/")[-4:])), path
        assert time == ((match.group(1) or None) if match else None), path
    df = spark.createDataFrame([("a",)], "path string").select(file_name(F.col("path")), file_timestamp(F.col("path")))
    assert "regexp" not in df._jdf.queryExecution().optimizedPlan().toString()


def test_durations(spark):
    row = spark.createDataFrame(
        [(datetime(2024, 1, 1, 10, 0, 0), datetime(2024, 1, 1, 11, 1, 31))], "s TIMESTAMP, e TIMESTAMP"
    ).select(
        elapsed_minutes(F.col("s"), F.col("e")).alias("minutes"),
        hours_minutes_seconds((F.unix_micros("e") - F.unix_micros("s")) / 1000 + 999).alias("hms"),
        with_time_of_day(F.lit("2020-05-05T99"), F.col("e")).alias("moved"),
    ).first()
    assert row["minutes"] == 61.52
    assert tuple(row["hms"]) == (1, 1, 31)
    assert row["moved"] == "2020-05-05 11:01:31.000000"


def test_procedure_message(spark):
    rows = [("progress", ""), (" SUCCESS ", " "), ("fail", "boom"), ("success", "kept"), ("other", "")]
    df = spark.createDataFrame(rows, "kind STRING, message STRING")
    texts = [
        r[0]
        for r in df.select(
            procedure_message(
                F.col("kind"), F.col("message"), F.lit("p"), F.lit(3), F.lit("inserted"), F.lit("t"), F.lit(7),
                F.lit(1.5),
            )
        ).collect()
    ]
    assert texts == [
        "Sql_seq: 3, No of records inserted in the  t table is 7",
        "Success.Minutes to execute  sp: 1.50",
        "Procedure Failed : p at the transaction no : 3, while doing  inserted for the table t,"
        "  Error_description : boom",
        "kept",
        "",
    ]
