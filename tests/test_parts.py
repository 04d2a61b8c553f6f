"""Tables in parts, kept sums, items by day, fingerprints, clustering and rejects."""

from __future__ import annotations

import random
import re
from collections import Counter
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from oremill import schemas
from oremill.config import environment
from oremill.operators import fingerprint, retract, upsert
from oremill.plans import gold, medallion
from oremill.plans.silver import CLEANERS
from oremill.sinks import clustering, keyed
from oremill.sinks.keyed import KeyedTable
from oremill.sources import rejects
from tests.test_files import T0, rebuilt, rows_of, write

STATE = "k STRING, v INT, w STRING"


def files_read(df) -> list[str]:
    return [f.removeprefix("file://") for f in df.inputFiles()]


# --- tables in parts ------------------------------------------------------------------------------------------


@pytest.fixture
def table(spark, tmp_path):
    found = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=16)
    found.commit(spark.createDataFrame([(f"k{n}", n, "x") for n in range(200)], STATE))
    return found


def test_commit_writes_only_parts_of_replaced_rows(spark, table):
    source = spark.createDataFrame([("k3", -3, "new"), ("k7", -7, "new"), ("other", 0, "new")], STATE)
    touched = table.parts_of(source)
    replaced = table.parts_of(source.filter("k <> 'other'"))
    assert table.upsert(source) == 2
    written = spark.read.parquet(f"{table.path}/table_version=2")
    assert sorted(r[0] for r in written.select(F.col("key_bucket").cast("string")).distinct().collect()) == touched
    commit = table.latest()
    for part in commit["parts"]:
        if part["part"] in replaced:
            assert part["versions"] == [2]  # written anew
        elif part["part"] in touched:
            assert part["versions"] == [1, 2]  # a row came, none was replaced
        else:
            assert part["versions"] == [1]
    expected = {f"k{n}": (n, "x") for n in range(200)} | {"k3": (-3, "new"), "k7": (-7, "new"), "other": (0, "new")}
    assert {r.k: (r.v, r.w) for r in table.read().collect()} == expected
    assert commit["row_count"] == 201 and {r.k: r.v for r in table.read(1).collect()} == {f"k{n}": n for n in range(200)}


def test_unread_parts(spark, table):
    """A read of some parts opens no file of any other, and an upsert reads none but those it touches."""
    some = table.parts_of(table.read().filter("k IN ('k1', 'k2')"))
    rows = table.read(of=some)
    assert files_read(rows) and all(any(f"/key_bucket={p}/" in f for p in some) for f in files_read(rows))
    assert {"k1", "k2"} <= {r.k for r in rows.collect()} and rows.count() < 100
    # Files of other parts may be broken without an upsert noticing.
    source = spark.createDataFrame([("k1", -1, "new")], STATE)
    for file in set(files_read(table.read())) - set(files_read(rows)):
        open(file, "w").close()
    table.upsert(source)
    assert [(r.v, r.w) for r in table.read(of=table.parts_of(source)).filter("k = 'k1'").collect()] == [(-1, "new")]


def test_upsert_in_parts_equals_upsert_of_the_whole(spark, table):
    source = spark.createDataFrame([(f"k{n}", -n, None) for n in range(150, 260)], STATE)
    for update in (None, ["v"], ["w"]):
        expected = rows_of(upsert.upsert(table.read(), source, ["k"], update))
        table.upsert(source, ["k"], update)
        assert rows_of(table.read()) == expected
    for bad in ([(None, 1, "x")], [("a", 1, "x"), ("a", 2, "x")]):
        with pytest.raises(ValueError, match="repeated or NULL"):
            table.upsert(spark.createDataFrame(bad, STATE))
    with pytest.raises(ValueError, match="dealt by"):
        table.upsert(source, ["w"])


def test_changes_tell_what_went_and_came(spark, table):
    v = table.current()
    table.upsert(spark.createDataFrame([("k1", -1, "a"), ("new", 5, "b")], STATE))
    table.upsert(spark.createDataFrame([("k1", 1, "x"), ("k2", -2, "c")], STATE))  # k1 is as it was
    table.replace(spark.createDataFrame([("k9",), (None,)], "k STRING"), table.read().limit(0))
    found = rows_of(table.changes(v, table.current()).select("sign", "k", "v", "w"))
    assert found == sorted([(1, "new", 5, "b"), (-1, "k2", 2, "x"), (1, "k2", -2, "c"), (-1, "k9", 9, "x")], key=repr)
    assert table.changes(v, v).count() == 0
    assert table.read().count() == 200 and table.read().filter("k = 'k9'").count() == 0
    table.commit(table.read())
    assert table.changes(v, table.current()) is None
    assert table.changes(table.current(), table.current()).count() == 0


def test_null_keys_and_emptied_parts(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/n", ["k"], buckets=4, noted=["k"])
    table.commit(spark.createDataFrame([(None, 1, "a"), ("b", 2, "b")], STATE))
    table.replace(spark.createDataFrame([(None,)], "k STRING"), spark.createDataFrame([(None, 9, "z")], STATE))
    assert rows_of(table.read()) == sorted([(None, 9, "z"), ("b", 2, "b")], key=repr)
    every = table.read()
    table.replace(every, every.limit(0))
    assert table.read().collect() == [] and table.latest()["row_count"] == 0 and table.read().columns == ["k", "v", "w"]
    table.upsert(spark.createDataFrame([("c", 3, "c")], STATE))
    assert rows_of(table.read()) == [("c", 3, "c")] and len(rows_of(table.read(2))) == 2
    empty = KeyedTable(spark, f"{tmp_path}/e", ["k"])
    empty.commit(every.limit(0))
    assert empty.read().collect() == []


def test_parts_of_many_folders_become_one(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(keyed, "MOST_FOLDERS", 2)
    table = KeyedTable(spark, f"{tmp_path}/f", ["k"], buckets=1)
    for n in range(4):
        table.upsert(spark.createDataFrame([(f"k{n}", n, "x")], STATE))
    assert [p["versions"] for p in table.latest()["parts"]] == [[3, 4]]
    assert len(rows_of(table.read())) == 4


def test_half_written_commit_in_parts_is_replaced(spark, table):
    table.read().write.parquet(f"{table.path}/table_version=2/key_bucket=0")  # a commit that died before it was logged
    table.upsert(spark.createDataFrame([("k1", -1, "new")], STATE))
    assert table.read().count() == 200


def test_table_by_day(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/d", ["k"], by="day")
    schema = "k STRING, day DATE"
    rows = spark.createDataFrame([("a", date(2024, 1, 1)), ("b", date(2024, 1, 2)), ("c", None)], schema)
    table.commit(rows)
    assert rows_of(table.read()) == rows_of(rows)
    assert {p["part"] for p in table.latest()["parts"]} == {"2024-01-01", "2024-01-02", keyed.NULL_PART}
    one = table.read().filter(F.col("day") == F.lit("2024-01-02").cast("date"))
    assert "PartitionFilters: [isnotnull(day" in one._jdf.queryExecution().executedPlan().toString() and one.count() == 1
    with pytest.raises(ValueError, match="by its key"):
        table.replace(rows, rows)


# --- kept sums ------------------------------------------------------------------------------------------------


def test_kept_sums_equal_sums_after_any_changes(spark):
    r = random.Random(2)
    row = lambda: (r.choice(["a", "b", None]), r.choice([None, 1, 2, 7]), r.choice([None, 0.1, 0.7, 1234567.89]))
    now = Counter(row() for _ in range(40))
    schema = "g STRING, n INT, x DOUBLE"
    sums = retract.summed(spark.createDataFrame([*now.elements()], schema), ["g"], "rows", {"n": F.col("n")}, {"x": F.col("x")})
    for step in range(4):
        gone = Counter(r.sample([*now.elements()], min(sum(now.values()), 25 if step < 3 else 10**6)))
        come = Counter(row() for _ in range(15)) if step < 3 else Counter()
        now = now - gone + come
        changes = retract.net(retract.signed(*(spark.createDataFrame([*c.elements()], schema) for c in (gone, come))))
        change = retract.summed(changes, ["g"], "rows", {"n": F.col("n")}, {"x": F.col("x")})
        sums = spark.createDataFrame(retract.add_up(sums, change, ["g"], "rows").collect(), sums.schema)
        shown = sums.select("g", "rows", retract.value_of("n", "long").alias("n"), retract.value_of("x", "double").alias("x"))
        whole = spark.createDataFrame([*now.elements()], schema)
        expected = whole.groupBy("g").agg(F.count(F.lit(1)).alias("rows"), F.sum("n").alias("n"), F.round(F.sum("x"), 6).alias("x"))
        assert rows_of(shown) == rows_of(expected), step
    assert sums.count() == 0


def test_kept_sums_take_back_exactly(spark):
    """In floating point 0.1 + 0.2 - 0.1 - 0.2 is not 0."""
    rows = spark.createDataFrame([(1, "g", 0.1), (1, "g", 0.2), (1, "g", 1e15), (1, "g", 1e30)], "sign LONG, g STRING, x DOUBLE")
    sums = retract.summed(rows, ["g"], "rows", amounts={"x": F.col("x")})
    gone = retract.summed(rows.withColumn("sign", F.lit(-1).cast("long")).filter("x > 0.1"), ["g"], "rows", amounts={"x": F.col("x")})
    left = retract.add_up(sums, gone, ["g"], "rows").collect()
    assert [(r.rows, r.x_values, str(r.x)) for r in left] == [(1, 1, "0.10000000")]


def test_refresh_reads_no_unchanged_items(spark, tmp_path):
    """After the first load the items' files of parts that nothing touches can be broken: marts still follow."""
    env = environment("prod", f"{tmp_path}/lake")
    landing = tmp_path / "lake" / "landing"
    for table in CLEANERS:
        (landing / table).mkdir(parents=True)
    write(landing / "customers" / "1.csv", ["h", *(f"c{n},Name {n},,,," for n in range(20))])
    write(landing / "products" / "1.csv", ["h", *(f"p{n},Thing {n},cat{n % 3},B,1" for n in range(20))])
    write(landing / "orders" / "1.csv", ["h", *(f"o{n},c{n % 20},2024-01-{1 + n % 28:02d},x" for n in range(100))])
    write(landing / "order_items" / "1.csv", ["h", *(f"i{n},o{n % 100},p{n % 20},{1 + n % 5},1.25" for n in range(300))])
    medallion.refresh(spark, env)
    write(landing / "order_items" / "2.csv", ["h", "i5,o5,p5,100,1.25", "i999,o7,p1,1,2.5"])
    write(landing / "orders" / "2.csv", ["h", "o3,c4,2024-02-01,x", "o4,c4,2024-01-05,cancelled"])
    items = medallion.silver_table(spark, env, "order_items")
    changed = spark.createDataFrame([("i5",), ("i999",)], "order_item_id STRING")
    kept = {f"/key_bucket={p}/" for p in items.parts_of(changed)}
    hidden = {}
    for file in files_read(items.read()):
        if not any(part in file for part in kept):
            hidden[file] = open(file, "rb").read()
            open(file, "w").close()
    assert len(hidden) > 10
    done = medallion.refresh(spark, env)
    assert set(done["gold"].values()) == {2}
    for file, data in hidden.items():
        open(file, "wb").write(data)
    for mart, expected in rebuilt(spark, env)[1].items():
        assert rows_of(medallion.mart_table(spark, env, mart).read()) == rows_of(expected), mart


def test_rows_of_touched_keys_are_shuffled_once_to_be_found_and_joined(spark, table, tmp_path):
    """The lookup by key leaves both tables dealt as the join by key needs them."""
    other = KeyedTable(spark, f"{tmp_path}/other", ["k"], buckets=16)
    other.commit(spark.createDataFrame([(f"k{n}", n, "y") for n in range(0, 300, 2)], STATE))
    keys = spark.createDataFrame([(f"k{n}",) for n in range(0, 400, 3)], "k STRING")
    settings = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.enabled": "false"}
    before = {k: spark.conf.get(k) for k in settings}
    try:
        for k, v in settings.items():
            spark.conf.set(k, v)
        some, more = (medallion._rows_of(keys, table.parts_of(keys), t, 1) for t in (table, other))
        both = some.join(more.withColumnRenamed("v", "u").drop("w"), "k")
        plan = both._jdf.queryExecution().executedPlan().toString()
        assert sorted((r.k, r.v, r.u) for r in both.collect()) == sorted((f"k{n}", n, n) for n in range(0, 200, 6))
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert plan.count("Exchange hashpartitioning") <= 4 and "coalesce(k" not in plan


def test_replace_finds_recurring_keys_whatever_they_are(spark, tmp_path):
    """NULL and repeated keys, and columns that are no key; rows that do not come again are found by their key's hash alone."""
    rows = [(None if n == 5 else f"k{n}", n, "x") for n in range(50)]
    found = KeyedTable(spark, f"{tmp_path}/t", ["k"], buckets=4)
    found.commit(spark.createDataFrame(rows, STATE))
    keys = spark.createDataFrame([(None,), ("k7",), ("k7",), ("new",)], "k STRING")
    gone = found._recurring(found.read(), keys)
    assert sorted(r.v for r in gone.collect()) == [5, 7]
    come = spark.createDataFrame([(None, -5, "y"), ("new", 1, "y")], STATE)
    found.replace(keys, come)
    assert sorted((r.k or "", r.v) for r in found.read().collect()) == sorted([(k or "", v) for k, v, _ in rows if v not in (5, 7)] + [("", -5), ("new", 1)])
    assert sorted((r.sign, r.v) for r in found.changes(1, 2).collect()) == [(-1, 5), (-1, 7), (1, -5), (1, 1)]


def test_refresh_that_died_is_completed(spark, tmp_path):
    """Sums that were brought up before a mart was do not hide the change from the mart."""
    env = environment("prod", f"{tmp_path}/lake")
    landing = tmp_path / "lake" / "landing"
    for table, line in {"customers": "c1,Ann,,,,", "products": "p1,Pen,a,B,1", "orders": "o1,c1,2024-01-01,x", "order_items": "i1,o1,p1,2,1.5"}.items():
        write(landing / table / "1.csv", ["h", line])
    medallion.refresh(spark, env)
    write(landing / "order_items" / "2.csv", ["h", "i1,o1,p1,2,1.5", "i2,o1,p1,1,1"])
    medallion.load_bronze(spark, env)
    medallion.refresh_silver(spark, env)
    medallion.derived(spark, env)["order_sums"].bring_up()  # and then it died
    medallion.refresh(spark, env)
    for mart, expected in rebuilt(spark, env)[1].items():
        assert rows_of(medallion.mart_table(spark, env, mart).read()) == rows_of(expected), mart


def test_items_by_day_follow_late_and_moved_orders(spark, tmp_path):
    env = environment("prod", f"{tmp_path}/lake")
    landing = tmp_path / "lake" / "landing"
    waves = [
        {"customers": ["c1,Ann,,,,"], "products": ["p1,Pen,a,B,1"], "orders": ["o1,c1,2024-01-01,x", "o2,c1,2024-01-02,x", "o5,c1,bad,x", "o8,c1,2024-01-20,x"], "order_items": ["i8,o8,p1,1,1", "i1,o1,p1,2,1.5", "i2,o2,p1,1,1", "i3,o3,p1,1,1", "i4,,p1,1,1", ",o2,p1,8,1", "i5,o5,p1,1,1"]},
        {"orders": ["o3,c1,2024-01-03,x"], "order_items": ["i6,o1,p1,1,1"]},  # an order after its items, a late item
        {"orders": ["o1,c1,2024-01-09,x"], "order_items": ["i2,o3,p1,5,1", "i4,o1,p1,1,1", ",o3,p1,9,1", "i5,,p1,1,1"]},  # an order and items that move
    ]
    for table in CLEANERS:
        (landing / table).mkdir(parents=True)
    for number, landed in enumerate(waves):
        for table, lines in landed.items():
            write(landing / table / f"{number}.csv", ["h", *lines])
        medallion.load_bronze(spark, env)
        for table in ("orders", "order_items"):
            medallion.refresh_silver_table(spark, env, table)
        assert medallion.refresh_items_by_day(spark, env) == number + 1
        tables, marts = rebuilt(spark, env)
        stored = medallion.items_by_day(spark, env)
        expected = medallion._dated(tables["order_items"], tables["orders"])
        assert rows_of(stored.read()) == rows_of(expected), number
        assert rows_of(gold.daily_sales_by_day(tables["orders"], stored.read())) == rows_of(marts["daily_sales"].filter("order_date IS NOT NULL"))
    assert medallion.refresh_items_by_day(spark, env) is None
    # Days that nothing touched are still what the first commit wrote.
    assert any(p["versions"] == [1] for p in stored.latest()["parts"])


def test_a_week_of_items_reads_a_week(spark, tmp_path):
    table = KeyedTable(spark, f"{tmp_path}/d", ["order_item_id"], by="order_date")
    first = date(2024, 1, 1)
    table.commit(spark.createDataFrame(
        [(f"i{n}", f"o{n}", "p", 1, 1.5, first + timedelta(days=n)) for n in range(40)],
        "order_item_id STRING, order_id STRING, product_id STRING, quantity INT, price_per_unit DOUBLE, order_date DATE",
    ))
    orders = spark.createDataFrame([(f"o{n}", first + timedelta(days=n)) for n in range(40)], "order_id STRING, order_date DATE")
    orders.write.parquet(f"{tmp_path}/o")
    orders = spark.read.parquet(f"{tmp_path}/o")
    window = gold.since(orders, date(2024, 2, 9), 7)
    mart = gold.daily_sales_by_day(window, table.read())
    assert mart.count() == 8
    plan = mart._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"PartitionFilters: \[[^]]*order_date", plan)
    # Days that only the data tell: the pruning is dynamic.
    changed = orders.filter(F.col("order_id").isin("o3", "o4"))
    mart = gold.daily_sales_by_day(changed, table.read())
    assert sorted(r.total_orders for r in mart.collect()) == [1, 1]
    assert "dynamicpruning" in mart._jdf.queryExecution().executedPlan().toString()


# --- fingerprints ---------------------------------------------------------------------------------------------


def test_differences_equal_brute_force(spark):
    r = random.Random(5)
    make = lambda n: [(r.choice([None, *range(60)]), r.choice([None, "a", "b"]), r.choice([None, 1, 2])) for _ in range(n)]
    source = make(300)
    target = [row for row in source if r.random() > 0.1] + make(15)
    schema = "k INT, a STRING, b INT"
    s, t = spark.createDataFrame(source, schema), spark.createDataFrame(target, schema).select("b", "k", "a")
    plus, minus = Counter(source) - Counter(target), Counter(target) - Counter(source)
    expected = {}
    for k in {row[0] for row in plus} | {row[0] for row in minus}:
        n, m = (sum(c for row, c in some.items() if row[0] == k) for some in (plus, minus))
        expected[k] = ("MISSING" if not m else "EXTRA" if not n else "CHANGED", n, m)
    for levels in ((2,), (1, 3), (4, 20), (12, 28)):
        found = fingerprint.differences(s, t, ["k"], levels=levels).collect()
        assert {x.k: (x.difference, x.source_rows, x.target_rows) for x in found} == expected
    assert fingerprint.differences(s, s.repartition(7), ["k"]).count() == 0
    assert fingerprint.differences(s.limit(0), s.limit(0), ["k"]).count() == 0


def test_fingerprints_see_what_counts_do_not(spark):
    schema = "k INT, a STRING, b STRING"
    cases = [
        ([(1, "x", None)], [(1, None, "x")]),  # a NULL in another place
        ([(1, "x", "y")], [(1, "y", "x")]),
        ([(1, "x", "y")] * 2 + [(2, "x", "y")], [(1, "x", "y")] + [(2, "x", "y")] * 2),  # one row lost, one doubled
        ([(1, "x", "y")] * 3, [(1, "x", "z")] * 2 + [(1, "x", "y")]),  # exclusive or alone cancels pairs
        ([(None, "x", "y")], [(1, "x", "y")]),
    ]
    for a, b in cases:
        a, b = spark.createDataFrame(a, schema), spark.createDataFrame(b, schema)
        [row] = fingerprint.reconcile_contents(a, b, ["k"]).collect()
        assert row.source_count == row.target_count and row.load_status == "FAILED"
        [row] = fingerprint.reconcile_contents(a, a.orderBy(F.desc("k")), ["k"]).collect()
        assert (row.load_status, row.missing, row.extra, row.changed) == ("COMPLETED", 0, 0, 0)


def test_fingerprints_send_ranges_not_rows(spark):
    """A task sends a row for each range, and rows that agree are not shuffled."""
    rows = spark.range(0, 200_000, 1, 4).select(F.col("id").alias("k"), (F.col("id") % 7).alias("v"))
    plan = fingerprint.fingerprints(rows, ["k"], bits=6)._jdf.queryExecution().executedPlan().toString()
    assert plan.index("partial_bit_xor") > plan.index("Exchange")
    other = rows.withColumn("v", F.when(F.col("k") == 77_777, 9).otherwise(F.col("v")))
    assert [tuple(r) for r in fingerprint.differences(rows, other, ["k"], levels=(8, 16)).collect()] == [(77_777, "CHANGED", 1, 1)]


# --- clustering -----------------------------------------------------------------------------------------------


def test_clustered_files_are_narrow_in_every_column(spark, tmp_path):
    r = random.Random(1)
    rows = [(r.choice([None, *"abcdefghijklmnopqrstuvwxyz"]), r.randrange(10_000), datetime(2024, 1, 1) + timedelta(minutes=r.randrange(500_000)), n) for n in range(6_000)]
    df = spark.createDataFrame(rows, "job STRING, n INT, at TIMESTAMP, id INT")
    cover = clustering.write_clustered(df, f"{tmp_path}/c", ["job", "n", "at"], 64)
    assert rows_of(spark.read.parquet(f"{tmp_path}/c/data")) == rows_of(df)
    total = cover.count()
    assert total >= 48
    day = datetime(2024, 6, 1)
    wants = [{"job": ("c", "d")}, {"n": (5_000, 5_400)}, {"at": (day, day + timedelta(days=9))}, {"n": (None, 300)}, {"job": ("x", None), "n": (9_000, None)}, {"job": ("zz", "zzz")}]
    for wanted in wants:
        found = clustering.read_clustered(spark, f"{tmp_path}/c", wanted)
        plain = df
        for column, (low, high) in wanted.items():
            plain = plain.filter((F.col(column) >= F.lit(low)) if low is not None else F.lit(True)).filter((F.col(column) <= F.lit(high)) if high is not None else F.lit(True))
        assert rows_of(found) == rows_of(plain)
        files = clustering.files_for(cover, wanted)
        assert len(files) <= total * 0.55 and {f.replace("file:///", "file:/") for f in found.inputFiles()} <= set(files), (wanted, len(files), total)
    # Sorted by one column alone, a filter on another reads nearly every file.
    df.repartitionByRange(64, "job").write.parquet(f"{tmp_path}/s")
    sorted_files = spark.read.parquet(f"{tmp_path}/s").groupBy(F.col("_metadata.file_path")).agg(F.min("n").alias("lo"), F.max("n").alias("hi"))
    assert sorted_files.filter("lo <= 5400 AND hi >= 5000").count() > 2 * len(clustering.files_for(cover, wants[1])) * sorted_files.count() / total


def test_clustering_of_odd_tables(spark, tmp_path):
    schema = "a INT, b STRING"
    for name, rows in {"empty": [], "nulls": [(None, None)] * 5, "ties": [(1, "x")] * 50, "one": [(3, None)]}.items():
        df = spark.createDataFrame(rows, schema)
        clustering.write_clustered(df, f"{tmp_path}/{name}", ["a", "b"], 4)
        assert rows_of(clustering.read_clustered(spark, f"{tmp_path}/{name}", {})) == rows_of(df)
        assert clustering.read_clustered(spark, f"{tmp_path}/{name}", {"a": (1, 1)}).count() == sum(r[0] == 1 for r in rows)
    assert clustering.read_clustered(spark, f"{tmp_path}/ties", {"a": (None, None)}).count() == 50
    cover = clustering.recluster(spark, f"{tmp_path}/ties", f"{tmp_path}/again", ["b"], 2)
    assert cover.columns == ["file", "file_rows", "b_min", "b_max", "b_nulls"]


def test_morton_keys_interleave(spark):
    df = spark.createDataFrame([(a, b) for a in range(4) for b in range(4)], "a INT, b INT")
    found = {(r.a, r.b): r.m for r in df.select("a", "b", clustering.morton([F.col("a"), F.col("b")], 2).alias("m")).collect()}
    assert found == {(a, b): int("".join(f"{a >> i & 1}{b >> i & 1}" for i in (1, 0)), 2) for a in range(4) for b in range(4)}
    cuts = [2, 4, 4, 9]
    ranks = spark.createDataFrame([(x,) for x in (None, 0, 2, 3, 4, 8, 9, 99)], "x INT").select("x", clustering.rank("x", cuts, schemas.TYPES["INT"]).alias("r"))
    assert {r.x: r.r for r in ranks.collect()} == {x: 0 if x is None else sum(c <= x for c in cuts) for x in (None, 0, 2, 3, 4, 8, 9, 99)}


# --- rejects --------------------------------------------------------------------------------------------------

LINES = ["a,b,c", "1,x,2", "2,y", "3,x,y,z", '4,"q,r",5', '5,"say ""hi"", now",6', '6,"open,7', "7,,", "", '8, "inner, 9"x,', "9"]


def test_malformed_lines_are_set_aside(spark, tmp_path):
    write(tmp_path / "in" / "Feed_20240101.csv", LINES)
    write(tmp_path / "in" / "Feed_20240102.csv", ["h", "1,2"])
    write(tmp_path / "in" / "Feed_20240103.csv", ["a,b,c"])
    schema = schemas.declared("a STRING, b STRING, c STRING")
    scan = rejects.read_with_rejects(spark, f"{tmp_path}/in", schema)
    assert rows_of(scan.rows.select("a", "b", "c", "FILE_TS")) == sorted(
        [("1", "x", "2", "20240101"), ("4", "q,r", "5", "20240101"), ("5", 'say "hi", now', "6", "20240101"), ("7", None, None, "20240101")], key=repr
    )
    found = {r.line: (r.reason, r.found_fields, r.expected_fields, r.FILE_TS) for r in scan.rejects.collect()}
    assert found["2,y"] == ("TOO_FEW_FIELDS", 2, 3, "20240101") and found["3,x,y,z"] == ("TOO_MANY_FIELDS", 4, 3, "20240101")
    assert found["9"][0] == "TOO_FEW_FIELDS" and found["1,2"][3] == "20240102" and found['6,"open,7'][0] == "OPEN_QUOTE"
    counts = {r.FILE_NAME.rsplit("_", 1)[1]: (r.good_rows, r.rejected_rows, r.source_count) for r in scan.counts().collect()}
    assert counts["20240101.csv"][2] == len([x for x in LINES[1:] if x]) and counts["20240102.csv"] == (0, 1, 1) and len(counts) == 2
    mended = rejects.retried(scan.rejects, schema, F.when(F.col("reason") == "TOO_FEW_FIELDS", F.concat("line", F.lit(",fixed"))))
    assert rows_of(mended.select("a", "b", "c")) == [("1", "2", "fixed"), ("2", "y", "fixed")]


def test_rejects_with_other_delimiters_and_refused_schemas(spark, tmp_path):
    write(tmp_path / "in" / "x.txt", ["1||2", "3", '"4||5"||6', "7||8||9"])
    schema = schemas.declared("a STRING, b STRING")
    scan = rejects.read_with_rejects(spark, f"{tmp_path}/in", schema, "||", header=False)
    assert rows_of(scan.rows.select("a", "b")) == [("1", "2"), ("4||5", "6")]
    assert rows_of(scan.rejects.select("line", "reason", "found_fields")) == [("3", "TOO_FEW_FIELDS", 1), ("7||8||9", "TOO_MANY_FIELDS", 3)]
    with pytest.raises(ValueError, match="text"):
        rejects.read_with_rejects(spark, f"{tmp_path}/in", schemas.declared("a INT"))
    with pytest.raises(ValueError, match="named like"):
        rejects.read_with_rejects(spark, f"{tmp_path}/in", schemas.declared("line STRING"))
