from __future__ import annotations

import os
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from oremill import schemas
from oremill.config import IngestSpec, environment
from oremill.plans import ingest, medallion
from oremill.plans.ingest import RunIds, run_ingest, task_specs
from oremill.plans import gold
from oremill.plans.silver import CLEANERS
from oremill.plans.table_load import load_table, upsert_table
from oremill.session import shuffle_partitions, sized_shuffles
from oremill.sinks import loads
from oremill.sinks.versions import VersionedTable
from oremill.sources import delimited, manifest
from oremill.streaming.incremental import INGEST_BATCH, ingest_new_files


def write(path, lines, modified: datetime | None = None):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text("\n".join(lines) + "\n")
    if modified:
        os.utime(path, (modified.timestamp(), modified.timestamp()))


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


# --- readers --------------------------------------------------------------------------------------------------


def test_declared_schema_is_matched_by_position(spark, tmp_path):
    lines = ["ProductID,ProductName,Category,Brand,UnitPrice", '"P-1","Pen","A","B","9.5"', "P-2,Pot"]
    write(tmp_path / "Products.csv", lines)
    df = delimited.read_with_schema(spark, str(tmp_path), schemas.BRONZE["products"])
    assert df.columns == schemas.BRONZE["products"].names
    assert rows_of(df) == [("P-1", "Pen", "A", "B", "9.5", None), ("P-2", "Pot", None, None, None, None)]


def test_quotes_and_blanks_survive(spark, tmp_path):
    write(tmp_path / "q.csv", ["a|b", '" say ""hi""|x "| two '])
    assert rows_of(delimited.read_quoted(spark, str(tmp_path), delimiter="|")) == [(' say "hi"|x ', " two ")]


@pytest.fixture
def small_splits(spark):
    setting = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(setting)
    spark.conf.set(setting, "2k")
    yield
    spark.conf.set(setting, before)


@pytest.mark.parametrize("skip", [0, 1, 2, 700])
def test_skip_rows_of_each_file(spark, tmp_path, small_splits, skip):
    """Files of many splits, of fewer rows than are skipped, and of no rows; 700 rows fill several splits."""
    sizes = {"Orders_20240101.csv": 3000, "Orders_20240102.csv": 1, "Plain.csv": 500, "Empty_20240103.csv": 0}
    for name, size in sizes.items():
        write(tmp_path / name, ["id,text"] + [f"{i},{name}" for i in range(size)])
    scan = delimited.read_delimited(spark, str(tmp_path))
    assert scan.rdd.getNumPartitions() > 4
    got = delimited.skip_leading_rows(scan, skip)
    expected = sorted((str(i), name) for name, size in sizes.items() for i in range(skip, size))
    assert sorted(tuple(r) for r in got.collect()) == expected


def test_skip_none_is_the_file(spark, tmp_path):
    write(tmp_path / "a.csv", ["id", "1"])
    got = delimited.skip_leading_rows(delimited.read_delimited(spark, str(tmp_path)), None, keep=("file_name",))
    assert rows_of(got) == [("1", "a.csv")]


# --- manifests ------------------------------------------------------------------------------------------------

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


@pytest.fixture
def landing(tmp_path):
    for i, name in enumerate(["Orders_20240101.csv", "monthly_20240102.csv", "Plain.csv", "Empty_20240103.csv"]):
        rows = [] if name.startswith("Empty") else [f"{i},{name}"] * (i + 1)
        write(tmp_path / "in" / name, ["id,text", *rows], T0 + timedelta(hours=i))
    return f"{tmp_path}/in"


def test_manifest_is_oldest_first_without_contents(spark, landing):
    files = manifest.file_manifest(spark, landing, oldest_first=True)
    assert [r["name"] for r in files.collect()] == [
        "Orders_20240101.csv", "monthly_20240102.csv", "Plain.csv", "Empty_20240103.csv"
    ]
    assert "content" not in files._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in manifest.file_manifest(spark, landing)._jdf.queryExecution().executedPlan().toString()


def test_latest_file(spark, landing):
    files = manifest.file_manifest(spark, landing)
    assert manifest.latest_file(files).first()["path"].endswith("Empty_20240103.csv")
    assert manifest.latest_file(files, "20240101").first()["path"].endswith("Orders_20240101.csv")
    assert manifest.latest_file_containing(files, "monthly").first()["path"].endswith("monthly_20240102.csv")
    assert manifest.latest_file(files, "2030").isEmpty()


def test_watermark_compares_times(spark, landing):
    files = manifest.file_manifest(spark, landing)
    later = manifest.files_after(files, F.lit(T0 + timedelta(hours=1)))
    assert sorted(r["name"] for r in later.collect()) == ["Empty_20240103.csv", "Plain.csv"]
    assert manifest.files_after(files).count() == 4


def test_counts_per_file_include_empty_files(spark, landing):
    files = manifest.file_manifest(spark, landing)
    counts = manifest.counts_per_file(files, delimited.read_delimited(spark, landing))
    assert {r["name"]: r["row_count"] for r in counts.collect()} == {
        "Orders_20240101.csv": 1, "monthly_20240102.csv": 2, "Plain.csv": 3, "Empty_20240103.csv": 0
    }


# --- loads ----------------------------------------------------------------------------------------------------


def test_load_types(spark, tmp_path):
    df = spark.range(5).select(F.col("id").cast("string").alias("id"))
    at = F.lit(T0)
    target = f"{tmp_path}/t"
    result = loads.load(df, target, "append", user="u", at=at)
    assert (result.source_count, result.target_count, result.status) == (5, 5, "COMPLETED")
    loads.load(df, target, "APPEND", user="u", at=at)
    assert loads.read_target(spark, target).count() == 10
    assert loads.read_target(spark, target).columns == ["id", "LOAD_BY", "LOAD_TS"]
    loads.load(df, target, "OVERWRITE_ONLY_LOAD_BY", user="u")
    assert rows_of(loads.read_target(spark, target)) == [(str(i), "u") for i in range(5)]
    lineage = df.withColumns({"FILE_NAME": F.lit("f"), "FILE_TS": F.lit("1")})
    loads.load(lineage, target, "OVERWRITE", user="u", at=at)
    assert loads.read_target(spark, target).columns == ["id", "LOAD_BY", "LOAD_TS", "FILE_NAME", "FILE_TS"]
    crud = loads.with_audit(df, "UPSERT", at=at, task_name="t").first()
    assert (crud["CRT_BY"], crud["UPD_BY"]) == ("t", "t")
    with pytest.raises(ValueError, match="FILE_NAME"):
        loads.load(df, target, "OVERWRITE")
    with pytest.raises(ValueError, match="unknown load type"):
        loads.load(df, target, "None")
    assert loads.load_from_query(df, f"{tmp_path}/q", "APPEND").target_count == 5


def test_default_user_is_the_session_user(spark):
    user = spark.range(1).select(F.current_user()).first()[0]
    assert loads.with_audit(spark.range(1), "APPEND").first()["LOAD_BY"] == user


def test_tables_by_name_and_truncation(spark, tmp_path):
    names = schemas.declare_layer(spark, "gold", "t_", f"{tmp_path}/db")
    assert names == [f"t_gold.{t}" for t in schemas.GOLD]
    row = spark.createDataFrame([("A", 1, 2.0)], schemas.GOLD["category_sales"])
    row.write.mode("append").insertInto("t_gold.category_sales")
    assert loads.read_target(spark, "t_gold.category_sales").count() == 1
    schemas.truncate_layer(spark, "gold", "t_")
    assert loads.read_target(spark, "t_gold.category_sales").count() == 0
    assert spark.table("t_gold.daily_sales").schema.names == ["order_date", "total_orders", "total_sales"]


def test_bucketed_tables_join_without_a_shuffle(spark, tmp_path):
    spark.sql(f"CREATE DATABASE bucketed LOCATION '{tmp_path}/db'")
    for name in ("l", "r"):
        df = spark.range(1000).select((F.col("id") % 100).alias("k"), F.col("id").alias(name))
        loads.write_bucketed(df, f"bucketed.{name}", "k", 4)
    right = spark.table("bucketed.r").groupBy("k").agg(F.sum("r").alias("r"))
    joined = spark.table("bucketed.l").hint("merge").join(right, "k")
    assert "Exchange" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 1000
    hot = spark.range(1000).select(F.when(F.col("id") % 3 > 0, -1).otherwise(F.col("id")).alias("k"))
    with pytest.raises(ValueError, match="too many for one of 4 buckets"):
        loads.write_bucketed(hot, "bucketed.hot", "k", 4)


def test_buckets_grow_with_stored_tables(spark, tmp_path):
    sizes = {}
    for rows in (1000, 100_000):
        spark.range(rows).select("id", F.uuid().alias("text")).repartition(3).write.parquet(f"{tmp_path}/{rows}")
        sizes[rows] = spark.read.parquet(f"{tmp_path}/{rows}")
    small, large = (loads.bucket_count([sizes[1000], df], "id", 2, 200_000) for df in sizes.values())
    stored = sum(p.stat().st_size for p in (tmp_path / "100000").glob("*.parquet"))
    assert (small, large) == (2, -(-stored // 200_000)) and large > 10
    hot = sizes[100_000].select(F.when(F.col("id") % 5 == 0, -1).otherwise(F.col("id")).alias("id"), "text")
    hot.write.parquet(f"{tmp_path}/hot")
    assert loads.bucket_count([spark.read.parquet(f"{tmp_path}/hot")], "id", 2, 200_000) == 5
    assert loads.bucket_count([sizes[1000].limit(0)], "id", 2) == 2


def test_replace_partitions_leaves_the_others(spark, tmp_path):
    target = f"{tmp_path}/t"
    loads.replace_partitions(spark.range(10).select("id", (F.col("id") % 2).alias("p")), target, ["p"])
    odd = spark.range(99, 100).select("id", F.lit(1).cast("long").alias("p"))
    loads.replace_partitions(odd, target, ["p"])
    assert rows_of(spark.read.parquet(target).select("id")) == [(i,) for i in (0, 2, 4, 6, 8, 99)]


def test_shuffles_are_sized_from_the_input(spark):
    assert shuffle_partitions(0, 8) == 8
    assert shuffle_partitions(100 * 2**30, 200) == 1600
    assert shuffle_partitions(100 * 2**40, 200) == 1_638_400
    setting = "spark.sql.adaptive.coalescePartitions.initialPartitionNum"
    with sized_shuffles(spark, 2**30) as count:
        assert count == 16 and spark.conf.get(setting) == "16"
    assert spark.conf.get(setting, None) is None


# --- ingest ---------------------------------------------------------------------------------------------------


def spec(landing, tmp_path, **changes):
    values = dict(job_name="j", task_name="orders", source_path=landing, target_path=f"{tmp_path}/bronze")
    return IngestSpec(**{**values, **changes})


def test_ingest_takes_each_file_once(spark, landing, tmp_path):
    log = f"{tmp_path}/log"
    task = spec(landing, tmp_path)
    first = T0 + timedelta(hours=1)
    assert run_ingest(spark, task, log, RunIds("1", "r1", "t1"), now=first) == "COMPLETED"
    assert spark.read.parquet(task.target_path).count() == 3  # the files of hours 0 and 1
    assert run_ingest(spark, task, log, RunIds("1", "r2", "t2"), now=T0 + timedelta(hours=9)) == "COMPLETED"
    table = spark.read.parquet(task.target_path)
    assert table.count() == 6
    assert table.columns == ["id", "text", "LOAD_BY", "LOAD_TS", "FILE_NAME", "FILE_TS", "LOAD_FROM"]
    assert all(r["FILE_NAME"].endswith(r["text"]) for r in table.collect())
    assert run_ingest(spark, task, log, RunIds("1", "r3", "t3"), now=T0 + timedelta(hours=10)) == "COMPLETED"
    assert table.count() == 6
    done = spark.read.parquet(f"{log}/task_control").filter("status = 'COMPLETED'").orderBy("execution_start_ts")
    assert [(r["source_count"], r["target_count"], r["last_processed_file"]) for r in done.collect()] == [
        (3, 3, "monthly_20240102.csv"), (3, 3, "Empty_20240103.csv"), (None, None, None)
    ]
    messages = spark.read.parquet(f"{log}/task_run_log").orderBy("task_run_id").collect()
    assert [m["primary_message"] for m in messages] == [
        "INFO:orders - COMPLETED,  2 files are processed",
        "INFO:orders - COMPLETED,  2 files are processed",
        "INFO:orders - COMPLETED,  No files available to process for the day",
    ]
    assert spark.read.parquet(f"{log}/file_log").count() == 4


def test_run_that_died_is_replaced_by_the_next(spark, landing, tmp_path, monkeypatch):
    """Whether it died after the rows, or after the rows and the list of files; nothing was logged then."""
    task, log = spec(landing, tmp_path), f"{tmp_path}/log"

    class Died(BaseException):
        pass

    def die(*_):
        raise Died

    for name in ("replace_partitions", "_log_message"):
        with monkeypatch.context() as patch:
            patch.setattr(ingest, name, die)
            if name == "_log_message":
                patch.setattr(ingest, "_log_state", lambda *a: None)
            with pytest.raises(Died):
                run_ingest(spark, task, log, RunIds("1", "r0", name), now=T0 + timedelta(hours=1))
        assert (name, spark.read.parquet(task.target_path).count(), [r[0] for r in spark.read.parquet(task.target_path).select('LOAD_FROM').distinct().collect()]) == (name, 3, ['first'])
    assert run_ingest(spark, task, log, RunIds("1", "r1", "t1"), now=T0 + timedelta(hours=9)) == "COMPLETED"
    assert spark.read.parquet(task.target_path).count() == 6
    assert spark.read.parquet(f"{log}/file_log").count() == 4


def test_lossy_write_fails(spark, landing, tmp_path, monkeypatch):
    audited = loads.with_audit
    monkeypatch.setattr(loads, "with_audit", lambda df, *a: audited(df, *a).filter("id > 0"))
    status = run_ingest(spark, spec(landing, tmp_path), f"{tmp_path}/log", RunIds("1", "r1", "t1"), now=T0 + timedelta(hours=9))
    assert status == "FAILED"
    done = spark.read.parquet(f"{tmp_path}/log/task_control").filter("source_count IS NOT NULL").first()
    assert (done["source_count"], done["target_count"]) == (6, 5)


def test_counts_beyond_an_int_are_logged(spark, tmp_path):
    ingest._log_state(spark, str(tmp_path), {"job_name": "j", "source_count": 3_000_000_000})
    assert spark.read.parquet(f"{tmp_path}/task_control").first()["source_count"] == 3_000_000_000


def test_ingest_latest_file_only(spark, landing, tmp_path):
    task = spec(landing, tmp_path, all_files=False, latest_only=True, load_type="APPEND", skip_rows=1)
    run_ingest(spark, task, f"{tmp_path}/log", RunIds("1", "r1", "t1"), now=T0 + timedelta(hours=2))
    assert [r["text"] for r in spark.read.parquet(task.target_path).collect()] == ["Plain.csv"] * 2


def test_failed_ingest_is_logged_and_raised(spark, landing, tmp_path):
    task = spec(landing, tmp_path, load_type="NONSENSE")
    with pytest.raises(ValueError, match="unknown load type"):
        run_ingest(spark, task, f"{tmp_path}/log", RunIds("1", "r1", "t1"), now=T0 + timedelta(hours=9))
    states = [r["status"] for r in spark.read.parquet(f"{tmp_path}/log/task_control").collect()]
    assert sorted(states) == ["FAILED", "INITIATED"]
    message = spark.read.parquet(f"{tmp_path}/log/task_run_log").first()["primary_message"]
    assert message.startswith("CRITICAL:orders - FAILED unknown load type")
    # Nothing moved the watermark: the next run takes all files.
    good = spec(landing, tmp_path)
    run_ingest(spark, good, f"{tmp_path}/log", RunIds("1", "r2", "t2"), now=T0 + timedelta(hours=9))
    assert spark.read.parquet(good.target_path).count() == 6


def test_spec_from_metadata(spark):
    values = {
        "job_name": "j", "task_name": "t", "source_adls_path": "in/orders", "target_schema": "bronze",
        "target_table": "orders", "source_file_extension": "csv", "source_file_header": "Y", "load_type": "APPEND",
        "ingest_all_files_from_adls": " y", "ingest_latest_files_from_adls": "N", "skip_rows": 2,
        "source_file_delimiter": "|",
    }
    schema = schemas.CONTROL["ingest_metadata"]
    row = spark.createDataFrame([tuple(values.get(n) for n in schema.names)], schema).first()
    assert IngestSpec.from_metadata(row, "/lake") == IngestSpec(
        "j", "t", "/lake/in/orders", "/lake/bronze/orders", "", "csv", True, "|", "APPEND", 2, True, False
    )


def test_task_specs_are_the_file_tasks(spark):
    schema = schemas.CONTROL["ingest_metadata"]
    base = {"job_name": "j", "source_file_extension": "csv", "source_adls_path": "in", "target_schema": "s"}
    rows = [
        {**base, "task_name": "a", "transformation_type": "adls_to_raw"},
        {**base, "task_name": "b", "transformation_type": "ADLS_TO_RAW", "execute_child_notebook": " y"},
        {**base, "task_name": "c", "transformation_type": "RAW_TO_REFINED"},
        {**base, "task_name": "d", "transformation_type": None},
    ]
    tasks = spark.createDataFrame([tuple(r.get(n) for n in schema.names) for r in rows], schema)
    assert [s.task_name for s in task_specs(tasks, "/lake")] == ["a"]


def test_table_loads(spark, tmp_path):
    schema = "k STRING, ts TIMESTAMP, v INT"
    first = spark.createDataFrame([("a", T0, 1), ("b", T0, 2)], schema)
    later = T0 + timedelta(days=1)
    source = spark.createDataFrame([("a", T0, 9), ("b", later, 3), ("c", later, 4)], schema)
    table = VersionedTable(spark, f"{tmp_path}/v")
    assert upsert_table(first, table, ["k"], "ts").target_count == 2
    assert upsert_table(source, table, ["k"], "ts").source_count == 2
    assert rows_of(table.read().select("k", "v")) == [("a", 1), ("b", 3), ("c", 4)]
    assert upsert_table(source, table, ["k"], "ts").target_count == 0
    assert table.current() == 2
    assert upsert_table(source, table, ["k"]).source_count == 3
    assert rows_of(table.read().select("k", "v")) == [("a", 9), ("b", 3), ("c", 4)]
    load_table(source, f"{tmp_path}/t", "OVERWRITE", lambda df: df.groupBy().agg(F.sum("v").alias("v")))
    load_table(source, f"{tmp_path}/t", "APPEND", lambda df: df.select(F.col("v").cast("long").alias("v")))
    assert rows_of(spark.read.parquet(f"{tmp_path}/t")) == [(16,), (3,), (4,), (9,)]


def test_stream_takes_each_file_once(spark, tmp_path):
    schema = schemas.payload(schemas.BRONZE["orders"])
    places = (f"{tmp_path}/in", schema, f"{tmp_path}/out", f"{tmp_path}/cp")
    write(tmp_path / "in" / "Orders_1.csv", ["OrderID,CustomerID,OrderDate,OrderStatus", "o1,c,2024-01-01,x"])
    assert ingest_new_files(spark, *places) == 1
    assert ingest_new_files(spark, *places) == 0
    for n in (2, 3):
        write(tmp_path / "in" / "sub" / f"Orders_{n}.csv", ["a,b,c,d", f"o{n},c,2024-01-01,x"])
    assert ingest_new_files(spark, *places, files_per_batch=1) == 2
    out = spark.read.parquet(f"{tmp_path}/out")
    assert rows_of(out.select("OrderID", "FILE_TS")) == [("o1", "1"), ("o2", "2"), ("o3", "3")]


# --- the whole refresh ----------------------------------------------------------------------------------------


def test_refresh_in_waves_equals_a_rebuild(spark, tmp_path):
    env = environment("dev", f"{tmp_path}/lake")

    def land(wave, table, *lines):
        write(tmp_path / "lake" / "landing" / table / f"{wave}.csv", ["header", *lines])

    def refresh(day):
        return medallion.refresh(spark, env, at=F.lit(T0 + timedelta(days=day)))

    land(1, "customers", "c1,Ann,a@x,2020-01-01,Rome,IT", "c2,Bob,b@x,bad,Oslo,NO")
    land(1, "products", "p1,Pen, a ,B,1.5", "p2,Pot,b,B,x")
    land(1, "orders", "o1,c1,2024-01-01,done", "o2,c2,2024-01-02,pending", "o3,c2,2024-01-02,cancelled")
    land(1, "order_items", "i1,o1,p1,2,1.5", "i2,o2,p2,1,4.0", "i3,o3,p1,9,9.0")
    assert set(refresh(1)["gold"].values()) == {1}
    assert medallion.mart_table(spark, env, "daily_sales").read().count() == 2

    land(2, "customers", "c2,Bobby,b@x,2021-01-01,Oslo,NO")
    land(2, "orders", "o2,c2,2024-01-02, CANCELLED ", "o4,c1,2024-01-03,new")
    land(2, "order_items", "i4,o4,p1,1,10.0", "i2,o2,p2,3,4.0")
    second = refresh(2)
    assert second["silver"] == {"customers": 2, "products": None, "orders": 2, "order_items": 2}
    assert set(second["gold"].values()) == {2}
    third = refresh(3)
    assert set(third["bronze"].values()) == {0}
    assert set(third["silver"].values()) | set(third["gold"].values()) == {None}

    for table, clean in CLEANERS.items():
        rebuilt = clean(spark.read.parquet(env.table_path("bronze", table))).drop("updated_ts")
        stored = medallion.silver_table(spark, env, table).read().drop("updated_ts")
        assert rows_of(stored) == rows_of(rebuilt)
    sales = medallion.mart_table(spark, env, "daily_sales").read()
    assert rows_of(sales.withColumn("order_date", F.col("order_date").cast("string"))) == [
        ("2024-01-01", 1, 3.0), ("2024-01-02", 1, 12.0), ("2024-01-03", 1, 10.0)
    ]
    assert rows_of(medallion.mart_table(spark, env, "customer_lifetime_value").read()) == [
        ("c1", "Ann", 2, 13.0), ("c2", "Bobby", 1, 12.0)
    ]
    versions = medallion.refresh_gold(spark, env, full=True)
    assert set(versions.values()) == {3}
    assert sales.count() == 3


def rebuilt(spark, env):
    """What the stored tables should hold: all of bronze cleaned at once, and the marts of that."""
    newest = (INGEST_BATCH, "ingest_ts")
    tables = {t: clean(spark.read.parquet(env.table_path("bronze", t)), newest=newest).drop("updated_ts") for t, clean in CLEANERS.items()}
    customers, products, orders, items = (tables[t] for t in ("customers", "products", "orders", "order_items"))
    return tables, {
        "daily_sales": gold.daily_sales(orders, items),
        "customer_lifetime_value": gold.customer_lifetime_value(customers, orders, items),
        "top_products": gold.top_products(products, items),
        "category_sales": gold.category_sales(products, items),
    }


# Each wave: the clock of its refresh, in days, and the lines that land.
WAVES = {
    "a gap": [
        (0, {"customers": ["c1,Ann,,,,", "c2,Bob,,,,"], "products": ["p1,Pen,a,B,1"], "orders": ["o1,c1,2024-01-01,x"], "order_items": ["i1,o1,p1,2,1.5"]}),
        (30, {"orders": ["o2,c2,2024-01-05,x"], "order_items": ["i2,o2,p1,1,5"]}),
    ],
    "a clock that steps back": [
        (9, {"customers": ["c1,Ann,,,,"], "products": ["p1,Pen,a,B,1"], "orders": ["o1,c1,2024-01-01,x"], "order_items": ["i1,o1,p1,2,1.5"]}),
        (2, {"customers": ["c1,Anna,,,,"], "orders": ["o1,c1,2024-01-02,x", "o3,c1,2024-01-01,x"], "order_items": ["i3,o3,p1,1,7"]}),
        (5, {"products": ["p1,Pencil,b,B,1"]}),
    ],
    "NULL keys, days and categories": [
        (1, {"customers": ["c1,Ann,,,,", ",X,,,,"], "products": ["p1,Pen,,B,1", ",Q,q,B,1"], "orders": ["o1,c1,bad,x"], "order_items": ["i1,o1,p1,2,1.5", ",o1,p1,3,1"]}),
        (2, {"customers": [",Y,,,,"], "orders": ["o2,c1,bad,x", ",c1,2024-01-01,x"], "order_items": [",o1,p1,4,1", ",o2,p1,5,1"]}),
        (3, {"products": ["p1,Pen,c,B,1"], "order_items": ["i9,o2,p1,1,9"]}),
    ],
    "late items, and what moves or goes": [
        (1, {"customers": ["c1,Ann,,,,", "c2,Bob,,,,"], "products": ["p1,Pen,a,B,1", "p2,Pot,b,B,1"], "orders": ["o1,c1,2024-01-01,x", "o2,c2,2024-01-02,x"], "order_items": ["i1,o1,p1,2,1.5", "i2,o2,p2,1,1"]}),
        (2, {"order_items": ["i3,o1,p2,1,100", "i4,o7,p1,1,3"]}),
        (3, {"orders": ["o2,c1,2024-01-04,x", "o7,c2,2023-01-01,x"], "order_items": ["i2,o1,p1,1,1"]}),
        (4, {"products": ["p2,Pot,a,B,1"], "customers": ["c3,Cy,,,,"], "orders": ["o1,c3,2024-01-01,cancelled"]}),
    ],
}


@pytest.mark.parametrize("name", WAVES)
def test_refresh_equals_a_rebuild_after_every_wave(spark, tmp_path, name):
    env = environment("prod", f"{tmp_path}/lake")
    for table in CLEANERS:
        (tmp_path / "lake" / "landing" / table).mkdir(parents=True)
    for number, (day, landed) in enumerate(WAVES[name]):
        for table, lines in landed.items():
            write(tmp_path / "lake" / "landing" / table / f"{number}.csv", ["header", *lines])
        medallion.refresh(spark, env, at=F.lit(T0 + timedelta(days=day)))
        tables, marts = rebuilt(spark, env)
        for table, expected in tables.items():
            assert rows_of(medallion.silver_table(spark, env, table).read().drop("updated_ts")) == rows_of(expected), table
        for mart, expected in marts.items():
            assert rows_of(medallion.mart_table(spark, env, mart).read()) == rows_of(expected), mart
    assert set(medallion.refresh(spark, env)["gold"].values()) == {None}


def test_null_marker_and_default_rule(spark, tmp_path):
    write(tmp_path / "m.csv", ["a,b,c", '1,"",\\N', "2,x,"])
    for read in (delimited.read_delimited, delimited.read_quoted):
        assert rows_of(read(spark, str(tmp_path))) == [("1", None, "\\N"), ("2", "x", None)]
        assert rows_of(read(spark, str(tmp_path), null_value="\\N")) == [("1", "", None), ("2", "x", None)]
    schema = schemas.declared("a STRING, b STRING, c STRING")
    assert rows_of(delimited.read_with_schema(spark, str(tmp_path), schema, null_value="\\N"))[0] == ("1", "", None)


def test_skipped_rows_shuffle_no_data(spark, tmp_path):
    """Also where the files are larger than what Spark broadcasts."""
    for n in range(3):
        write(tmp_path / "in" / f"{n}.csv", ["id,text", *(f"{i},{'x' * 40}" for i in range(3000))])
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "20k")
    try:
        got = delimited.skip_leading_rows(delimited.read_delimited(spark, f"{tmp_path}/in"), 5)
        assert got.count() == 3 * 2995
        got.collect()
        plan = got._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan and "hashpartitioning" not in plan


def test_environments():
    assert [environment(n, "/x/").incremental_days for n in ("dev", "UAT", "prod")] == [1, 3, 7]
    assert environment("dev", "/x/").table_path("gold", "t") == "/x/gold/t"
    with pytest.raises(ValueError, match="unknown environment"):
        environment("nowhere", "/x")
