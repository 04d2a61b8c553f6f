from __future__ import annotations

import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oremill.operators import asof, dedup, distinct_days, project, runlog, upsert
from oremill.plans import gold, silver
from oremill.schemas import BRONZE, CONTROL, SILVER
from oremill.sinks.versions import VersionedTable
from oremill.workload import derive

DAY = datetime(2024, 1, 1)


def rows_of(df):
    return sorted((tuple(r) for r in df.collect()), key=repr)


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


# --- dedup ----------------------------------------------------------------------------------------------------


def test_latest_record_wins_whatever_the_partitioning(spark):
    rng = random.Random(7)
    rows = [(rng.choice(["a", "b", None, "hot"]), rng.randint(0, 3), rng.randint(0, 9)) for _ in range(500)]
    df = spark.createDataFrame(rows, "k STRING, ts INT, v INT")
    expected = {}
    for k, ts, v in rows:
        expected[k] = max(expected.get(k, (-1, -1)), (ts, v))
    for partitions in (1, 17):
        kept = dedup.latest_per_key(df.repartition(partitions), ["k"], ["ts"])
        assert {r["k"]: (r["ts"], r["v"]) for r in kept.collect()} == expected


def test_dedup_drops_before_the_shuffle(spark):
    df = spark.range(100).select((F.col("id") % 3).alias("k"), F.col("id").alias("v"))
    plan = plan_of(dedup.latest_per_key(df, ["k"], ["v"]))
    assert plan.index("Final") < plan.index("Exchange hashpartitioning") < plan.index("Partial")


def test_nulls_order_last(spark):
    df = spark.createDataFrame([("a", None, 9), ("a", 1, 0)], "k STRING, ts INT, v INT")
    assert rows_of(dedup.latest_per_key(df, ["k"], ["ts"])) == [("a", 1, 0)]


def test_rank_within_is_row_number(spark):
    rng = random.Random(3)
    rows = [
        (rng.choice(["hot", "hot", "b", None]), DAY + timedelta(minutes=rng.randint(0, 600)) if i % 9 else None, i)
        for i in range(400)
    ]
    df = spark.createDataFrame(rows, "k STRING, ts TIMESTAMP, id INT")
    got = {r["id"]: r["rn"] for r in dedup.rank_within(df, ["k"], "ts", ["id"]).collect()}
    assert len(got) == len(rows)
    for key in {"hot", "b", None}:
        group = [r for r in rows if r[0] == key]
        group.sort(key=lambda r: (r[1] is not None, r[1] or DAY, r[2]), reverse=True)
        assert [got[r[2]] for r in group] == list(range(1, len(group) + 1))


def test_no_task_ranks_a_hot_run(spark):
    """All rows in one hour, and all starts NULL: the run still fills many partitions of the sort."""
    for start in ("timestamp '2024-01-01 00:00:00'", "cast(null as timestamp)"):
        df = spark.range(2000).selectExpr("'hot' AS k", f"{start} AS ts", "id").repartition(4)
        got = dedup.rank_within(df, ["k"], "ts", ["id"])
        assert sorted((r["rn"], r["id"]) for r in got.collect()) == [(n + 1, 1999 - n) for n in range(2000)]
        assert "Window" not in str(got._jdf.queryExecution().optimizedPlan().toString()).replace("Window [sum(_rows", "")


# --- projections ----------------------------------------------------------------------------------------------


def test_align_orders_casts_and_drops(spark):
    df = spark.createDataFrame(
        [("7", "x", "o1", "i1", "1.5")],
        "quantity STRING, extra STRING, order_id STRING, order_item_id STRING, price_per_unit STRING",
    )
    ready = df.withColumns({"product_id": F.lit("p"), "updated_ts": F.lit(DAY)})
    aligned = project.align_to_schema(ready, SILVER["order_items"])
    assert [(f.name, f.dataType) for f in aligned.schema] == [(f.name, f.dataType) for f in SILVER["order_items"]]
    assert aligned.first()["quantity"] == 7
    with pytest.raises(Exception, match="price_per_unit"):
        project.align_to_schema(ready.drop("price_per_unit"), SILVER["order_items"])


# --- cleaning -------------------------------------------------------------------------------------------------


def test_cancelled_record_leaves_the_earlier_one(spark):
    rows = [
        ("o1", "c1", "2024-01-01", "pending", DAY),
        ("o1", "c1", "2024-01-01", " Cancelled", DAY + timedelta(days=1)),
        ("o2", "c1", "bad", None, DAY),
    ]
    bronze = spark.createDataFrame(rows, BRONZE["orders"])
    assert [r["order_id"] for r in silver.silver_orders(bronze).collect()] == ["o1"]
    kept = silver.silver_orders(bronze, keep_null_status=True).orderBy("order_id").collect()
    assert [(r["order_id"], r["order_date"] is None) for r in kept] == [("o1", False), ("o2", True)]


# --- marts ----------------------------------------------------------------------------------------------------


@pytest.fixture(scope="module")
def sales(spark):
    orders = spark.createDataFrame(
        [("o1", "c1", "2024-01-01"), ("o2", "c1", "2024-01-01"), ("o3", "c2", "2024-01-02"), ("o4", "c2", None)],
        "order_id STRING, customer_id STRING, order_date STRING",
    ).withColumn("order_date", F.col("order_date").cast("date"))
    items = spark.createDataFrame(
        [("o1", "p1", 2, 1.5), ("o1", "p2", None, 9.0), ("o2", "p1", None, 1.0), ("o3", None, 1, 4.0),
         ("o9", "p1", 5, 1.0), ("o4", "p2", 1, 2.0)],
        "order_id STRING, product_id STRING, quantity INT, price_per_unit DOUBLE",
    )
    customers = spark.createDataFrame([("c1", "Ann"), ("c3", "Cy")], "customer_id STRING, full_name STRING")
    products = spark.createDataFrame(
        [("p1", "Pen", "A"), ("p2", "Pot", None)], "product_id STRING, product_name STRING, category STRING"
    )
    return customers, products, orders, items


def test_daily_sales_counts_orders_and_skips_null_amounts(sales):
    _, _, orders, items = sales
    days = gold.daily_sales(orders, items).collect()
    got = {str(r["order_date"]): (r["total_orders"], r["total_sales"]) for r in days}
    assert got == {"2024-01-01": (2, 3.0), "2024-01-02": (1, 4.0), "None": (1, 2.0)}


def test_daily_sales_add_up_to_their_input(spark, sf_dir):
    orders = silver.silver_orders(derive.orders(spark, sf_dir))
    items = silver.silver_order_items(derive.order_items(spark, sf_dir))
    amounts = items.join(orders, "order_id").agg(F.sum(F.col("quantity") * F.col("price_per_unit"))).first()[0]
    days = gold.daily_sales(orders, items).agg(F.sum("total_orders"), F.sum("total_sales")).first()
    assert days[0] == orders.join(items, "order_id", "left_semi").count()
    assert days[1] == pytest.approx(amounts)


def test_lifetime_value_drops_unknown_and_idle_customers(sales):
    customers, _, orders, items = sales
    assert rows_of(gold.customer_lifetime_value(customers, orders, items)) == [("c1", "Ann", 2, 3.0)]


def test_product_and_category_marts(sales):
    _, products, _, items = sales
    assert rows_of(gold.top_products(products, items)) == [("p1", "Pen", 7, 8.0), ("p2", "Pot", 1, 2.0)]
    assert rows_of(gold.category_sales(products, items)) == sorted([("A", 7, 8.0), (None, 1, 2.0)], key=repr)


def test_since_takes_the_window_and_later(sales):
    _, _, orders, _ = sales
    assert gold.since(orders, DAY.date() + timedelta(days=2), 1).count() == 1


def test_hot_order_is_summed_before_it_is_shuffled(spark):
    orders = spark.createDataFrame([("hot", "c", DAY.date())], "order_id STRING, customer_id STRING, order_date DATE")
    items = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("o"), "id")).alias("order_id"),
        F.lit(1).alias("quantity"), F.lit(2.0).alias("price_per_unit"),
    )
    mart = gold.daily_sales(orders, items)
    assert rows_of(mart) == [(DAY.date(), 1, 2000.0)]
    lines = plan_of(mart).splitlines()
    assert any("partial_sum" in line for line in lines)


def test_stored_window_prunes_items_by_a_bloom_filter(spark, tmp_path):
    orders = spark.range(1000).select(
        F.col("id").cast("string").alias("order_id"), F.lit("c").alias("customer_id"),
        F.date_add(F.lit(DAY.date()), (F.col("id") % 100).cast("int")).alias("order_date"),
    )
    items = spark.range(4000).select(
        (F.col("id") % 1000).cast("string").alias("order_id"),
        F.lit(1).alias("quantity"),
        F.lit(1.0).alias("price_per_unit"),
    )
    for name, df in (("orders", orders), ("items", items)):
        df.write.parquet(f"{tmp_path}/{name}")
    stored = [spark.read.parquet(f"{tmp_path}/{name}") for name in ("orders", "items")]
    setting = "spark.sql.optimizer.runtime.bloomFilter.applicationSideScanSizeThreshold"
    before = spark.conf.get(setting)
    try:
        spark.conf.set(setting, "1")  # as if the items were large
        window = gold.since(stored[0], DAY.date() + timedelta(days=99), 1)
        mart = gold.daily_sales(window, stored[1])
        plan = plan_of(mart)
        assert "might_contain" in plan and "GreaterThanOrEqual(order_date" in plan
        assert mart.count() == 2
    finally:
        spark.conf.set(setting, before)


# --- upsert ---------------------------------------------------------------------------------------------------


@pytest.fixture
def states(spark):
    target = spark.createDataFrame([("a", 1, "x"), ("b", 2, None), (None, 3, "n")], "k STRING, v INT, w STRING")
    source = spark.createDataFrame([("b", 20, "B"), ("c", 30, None), (None, 40, "N")], "k STRING, v INT, w STRING")
    return target, source


def test_upsert_updates_inserts_and_keeps(states):
    target, source = states
    got = rows_of(upsert.upsert(target, source, ["k"]))
    # A NULL key matches nothing: both rows stay.
    assert got == sorted([("a", 1, "x"), ("b", 20, "B"), ("c", 30, None), (None, 3, "n"), (None, 40, "N")], key=repr)
    assert rows_of(upsert.merge_increment(target, source, ["k"])) == got


def test_upsert_of_some_columns(states):
    target, source = states
    got = rows_of(upsert.upsert(target, source.filter("k IS NOT NULL"), ["k"], update=["v"]))
    assert got == sorted([("a", 1, "x"), ("b", 20, None), ("c", 30, None), (None, 3, "n")], key=repr)


def test_upsert_twice_is_upsert_once(states):
    target, source = states
    source = source.filter("k IS NOT NULL")
    once = upsert.upsert(target, source, ["k"])
    assert rows_of(upsert.upsert(once, source, ["k"])) == rows_of(once)


def test_replace_window_drops_what_vanished(states):
    target, source = states
    got = rows_of(upsert.replace_window(target, source.filter("k = 'c'"), F.col("v") >= 2))
    assert got == sorted([("a", 1, "x"), ("c", 30, None)], key=repr)


def test_commit_refuses_bad_keys(spark, states, tmp_path):
    target, source = states
    table = VersionedTable(spark, f"{tmp_path}/t")
    with pytest.raises(ValueError, match="NULL keys"):
        table.upsert(source, ["k"])
    twice = source.filter("k = 'b'")
    with pytest.raises(ValueError, match="repeated"):
        table.upsert(twice.union(twice), ["k"])
    assert table.current() is None


def test_versions_can_be_read_back(spark, states, tmp_path):
    target, source = (df.filter("k IS NOT NULL") for df in states)
    table = VersionedTable(spark, f"{tmp_path}/t")
    assert table.upsert(target, ["k"], mark="m1") == 1
    assert table.upsert(source, ["k"]) == 2
    assert rows_of(table.read(1)) == rows_of(target)
    assert rows_of(table.read()) == [("a", 1, "x"), ("b", 20, "B"), ("c", 30, None)]
    assert [(r["version"], r["row_count"], r["mark"]) for r in table.history().orderBy("version").collect()] == [
        (1, 2, "m1"), (2, 3, None)
    ]


def test_half_written_version_is_replaced(spark, states, tmp_path):
    target, source = states
    table = VersionedTable(spark, f"{tmp_path}/t")
    source.write.parquet(f"{tmp_path}/t/v=1")  # a commit that died before it was logged
    assert table.current() is None
    table.commit(target)
    assert rows_of(table.read()) == rows_of(target)


def test_upsert_since_watermark(spark):
    schema = "k STRING, ts TIMESTAMP, v INT"
    target = spark.createDataFrame([("a", DAY, 1), ("b", DAY, 2)], schema)
    later = DAY + timedelta(days=1)
    source = spark.createDataFrame(
        [("a", DAY, 99), ("b", later, 3), ("b", later + timedelta(days=1), 4), ("c", later, 5)], schema
    )
    got = rows_of(upsert.upsert_since_watermark(target, source, ["k"], "ts").select("k", "v"))
    assert got == [("a", 1), ("b", 4), ("c", 5)]
    old = source.filter(F.col("ts") == F.lit(DAY))
    assert rows_of(upsert.upsert_since_watermark(target, old, ["k"], "ts")) == rows_of(target)
    first = upsert.upsert_since_watermark(target.filter("false"), source, ["k"], "ts")
    assert rows_of(first.select("k", "v")) == [("a", 99), ("b", 4), ("c", 5)]
    everything = upsert.upsert_since_watermark(target, source.filter("v <> 3"), ["k"], None)
    assert rows_of(everything.select("k", "v")) == [("a", 99), ("b", 4), ("c", 5)]


# --- run log --------------------------------------------------------------------------------------------------


def control(spark, rows):
    columns = "job_name STRING, parent_run_id STRING, task_name STRING, status STRING, execution_start_ts TIMESTAMP"
    return spark.createDataFrame([(*r, DAY) for r in rows], columns)


def test_restart_set_is_what_only_failed(spark):
    log = control(spark, [
        ("j", "r", "only", "FAILED"), ("j", "r", "only", "FAILED"), ("j", "r", "mixed", "FAILED"),
        ("j", "r", "mixed", "COMPLETED"), ("j", "r", "done", "COMPLETED"), ("j", "r2", "done", "FAILED"),
        ("j", "r", None, "COMPLETED"),
    ])
    assert rows_of(runlog.restart_set(log)) == [("j", "r", "only"), ("j", "r2", "done")]


def metadata(spark):
    rows = [("j", "only", "g", "y"), ("j", "mixed", "g", "Y"), ("j", "off", "g", "N"), ("j", "other", "h", "Y"),
            ("j", "only", "g", "y")]
    return spark.createDataFrame(rows, "job_name STRING, task_name STRING, grouping_id STRING, is_active STRING")


def test_tasks_to_start(spark):
    def names(log, group="g"):
        return sorted(r["task_name"] for r in runlog.tasks_to_start(log, metadata(spark), "j", "r", group).collect())

    fresh = control(spark, [("j", "older", "only", "FAILED")])
    assert names(fresh) == ["mixed", "only"]
    clean = control(spark, [("j", "r", "only", "COMPLETED"), ("j", "r", "other", "FAILED")])
    assert names(clean) == ["mixed", "only"]
    broken = control(spark, [("j", "r", "only", "FAILED"), ("j", "r", "mixed", "COMPLETED")])
    assert names(broken) == ["only"]
    announced = runlog.not_started_rows(runlog.active_tasks(metadata(spark), "j", "g"), "id", "r")
    assert announced.columns == CONTROL["task_control"].names
    known = announced.select("job_name", "job_id", "parent_run_id", "task_name", "status")
    assert rows_of(known) == [("j", "id", "r", "mixed", "NOT STARTED"), ("j", "id", "r", "only", "NOT STARTED")]


def test_reconcile_treats_a_missing_count_as_a_mismatch(spark):
    log = spark.createDataFrame(
        [("t1", 5, 5), ("t2", 5, 4), ("t3", 5, None), ("t4", None, None)],
        "task_name STRING, source_count INT, target_count INT",
    )
    got = {r["task_name"]: (r["load_status"], r["load_message"]) for r in runlog.reconcile(log).collect()}
    assert got["t1"] == ("COMPLETED", "t1 - COMPLETED")
    assert got["t2"] == ("FAILED", "t2 - FAILED source and target counts are not matching!")
    assert got["t3"][0] == "FAILED" and got["t4"][0] == "COMPLETED"


def test_watermark_default(spark):
    log = control(spark, [("j", "r", "t", "FAILED")]).withColumn("filter_end_ts", F.col("execution_start_ts"))
    assert runlog.watermark_per_task(log).first()["watermark"] == datetime(1900, 1, 1)


def test_retention_keeps_the_boundary(spark):
    df = spark.createDataFrame([(DAY,), (DAY - timedelta(seconds=1),)], "ts TIMESTAMP")
    assert runlog.retention_filter(df, F.lit(DAY + timedelta(days=180)), "ts").count() == 1


# --- as-of joins and bitmaps ----------------------------------------------------------------------------------


def test_asof_join_equals_brute_force(spark):
    r = random.Random(3)
    times = [None, *(DAY + timedelta(minutes=m) for m in range(30))]
    # One key has most of the rows and events, so it fills several partitions of the sort.
    key = lambda: r.choice(["hot"] * 6 + ["a", "b", None, "rows only"])
    rows = [(key(), r.choice(times), n % 40) for n in range(300)]
    events = [(k, r.choice(times), n) for n, k in enumerate(key() for _ in range(120)) if k != "rows only"]
    left = spark.createDataFrame(rows, "k STRING, t TIMESTAMP, v INT")
    right = spark.createDataFrame(events, "k STRING, at TIMESTAMP, id INT")
    found = sorted(((x.k, x.t, x.v, x.event.id if x.event else None) for x in asof.asof_join(left, right, ["k"], "t", "at", ["id"]).collect()), key=repr)
    expected = []
    for k, t, v in rows:
        before = [(at, i) for ek, at, i in events if ek == k and at is not None and t is not None and at <= t]
        expected.append((k, t, v, max(before)[1] if before else None))
    assert found == sorted(expected, key=repr) and sum(e[3] is None for e in expected) > 10
    assert asof.asof_join(left.limit(0), right, ["k"], "t", "at", ["id"]).count() == 0
    assert {x.event for x in asof.asof_join(left, right.limit(0), ["k"], "t", "at", ["id"]).collect()} == {None}


def test_asof_join_cuts_a_hot_key(spark):
    rows = spark.range(4_000).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("t"), "id")
    events = spark.range(0, 4_000, 100).select(F.lit("k").alias("k"), F.timestamp_seconds("id").alias("at"), "id")
    found = asof.asof_join(rows, events, ["k"], "t", "at", ["id"])
    assert found.filter(F.col("event.id") != F.floor(F.col("id") / 100) * 100).count() == 0 and found.count() == 4_000
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(_part" in plan and "NestedLoop" not in plan


def test_files_are_attributed_to_runs(spark):
    at = lambda m: DAY + timedelta(minutes=m)
    runs = [("j", "t", "r1", at(10), at(20)), ("j", "t", "r2", at(30), None), ("j", "t", "r3", at(30), at(31)), ("j", "u", "r4", at(0), at(99))]
    files = [("j", "t", f"f{m}", at(m)) for m in (5, 10, 20, 25, 30, 40)] + [("x", "t", "other", at(15))]
    found = asof.attribute_files(
        spark.createDataFrame(files, "job_name STRING, task_name STRING, path STRING, modified TIMESTAMP"),
        spark.createDataFrame(runs, "job_name STRING, task_name STRING, task_run_id STRING, execution_start_ts TIMESTAMP, execution_end_ts TIMESTAMP"),
    )
    assert {x.path: (x.task_run_id, x.in_run) for x in found.collect()} == {
        "f5": (None, False), "f10": ("r1", True), "f20": ("r1", True), "f25": ("r1", False), "f30": ("r3", True), "f40": ("r3", False), "other": (None, False)
    }


def test_bitmaps_count_distinct_over_any_span(spark):
    r = random.Random(7)
    rows = [(r.randrange(12), r.choice([None, *(f"c{n}" for n in range(70_000, 70_400))])) for _ in range(3_000)]
    rows += [(0, f"c{n}") for n in range(40_000)]  # more values than a piece has bits
    schema = "day INT, c STRING"
    first = spark.createDataFrame([x for x in rows if x[0] < 6], schema).repartition(5)
    later = spark.createDataFrame([x for x in rows if x[0] >= 4], schema)  # days 4 and 5 come twice
    numbers = distinct_days.numbered(first, "c")
    numbers = spark.createDataFrame(numbers.collect(), numbers.schema)
    more = distinct_days.numbered(later, "c", numbers)
    known = {x.c: x.number for x in more.collect()}
    assert sorted(known.values()) == list(range(len({c for _, c in rows if c})))
    assert all(known[x.c] == x.number for x in numbers.collect())
    kept = distinct_days.bitmaps(first.join(numbers, "c"), ["day"])
    kept = distinct_days.add_days(kept, distinct_days.bitmaps(later.join(more, "c"), ["day"]), ["day"])
    for span in (1, 3, 5, 12):
        found = {x.s: x.n for x in distinct_days.counted(kept.withColumn("s", F.floor(F.col("day") / span)), ["s"], "n").collect()}
        assert found == {s: len({c for d, c in rows if d // span == s and c}) for s in {d // span for d, c in rows if c}}
    assert distinct_days.numbered(first.limit(0), "c").count() == 0
