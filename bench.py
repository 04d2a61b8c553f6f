"""Time the headline queries and print one JSON line.

``BENCH_SF_DIR`` (tables), ``BENCH_CPUS`` (local cores) and ``BENCH_RUNS`` (timed runs, after one warm-up) are read from
the environment.  A query is written to Spark's ``noop`` sink, so every row is computed and none is collected.

``queries`` derive raw rows from the given tables, clean them and build the result in one go, nothing being cached.
``stored`` are the same marts over silver tables stored once beforehand, as in production.  ``written`` are jobs that
write, each run once: the refresh of a first load, of the last days' orders, and without news; a silver merge; and the
ingest of files by a task, with the first rows of each skipped.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from oremill.config import environment
from oremill.operators.upsert import merge_increment
from oremill.plans import gold, medallion, silver
from oremill.session import scratch_dir, tuned
from oremill.workload import derive
from oremill.workload.queries import INCREMENTAL_DAYS, QUERIES, _land_at

SF_DIR = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS", "8")
RUNS = int(os.environ.get("BENCH_RUNS", "3"))

HEADLINE = [
    "silver_customers", "silver_products", "silver_orders", "silver_order_items",
    "gold_daily_sales", "gold_daily_sales_incr", "gold_customer_ltv", "gold_top_products", "gold_category_sales",
    "gold_ltv_affected_keys", "upsert_daily_sales", "upsert_customer_ltv", "upsert_top_products",
    "watermark_per_task", "restart_set", "run_rank", "reconcile_loads", "new_files_since",
]


def seconds(run) -> float:
    run()
    times = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        times.append(time.perf_counter() - start)
    return round(statistics.median(times), 3)


def drain(df) -> None:
    df.write.format("noop").mode("overwrite").save()


def main() -> None:
    builder = (
        SparkSession.builder.master(f"local[{CPUS}]")
        .appName("oremill-bench")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .config("spark.sql.shuffle.partitions", CPUS)
        .config("spark.driver.memory", os.environ.get("BENCH_MEMORY", "8g"))
    )
    builder = builder.config("spark.checkpoint.dir", os.environ.get("BENCH_SCRATCH") or tempfile.mkdtemp(prefix="bench-"))
    spark = tuned(builder).getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    timings = {}
    for name in sys.argv[1:] or HEADLINE:
        timings[name] = seconds(lambda: drain(QUERIES[name](spark, SF_DIR)))
        print(name, timings[name], file=sys.stderr, flush=True)
    print(
        json.dumps({
            "metric": "total seconds of the headline queries (median of runs)",
            "value": round(sum(timings.values()), 3), "unit": "sec", "queries": timings,
            "stored": {} if sys.argv[1:] else stored(spark),
            "written": {} if sys.argv[1:] else written(spark),
            "sf": os.path.basename(SF_DIR.rstrip("/")).removeprefix("sf"), "cpus": CPUS, "runs": RUNS,
        })
    )
    spark.stop()


def stored(spark: SparkSession) -> dict[str, float]:
    """Marts over stored silver, and the cleaning itself over stored bronze."""
    bronze, tables, timings = {}, {}, {}
    for table, rows in derive.BRONZE.items():
        path = scratch_dir(spark, f"bench-bronze-{table}")
        rows(spark, SF_DIR).repartition(int(CPUS)).write.parquet(path)
        bronze[table] = spark.read.parquet(path)
        timings[f"clean_{table}"] = seconds(lambda: drain(silver.CLEANERS[table](bronze[table], derive.stamp())))
        path = scratch_dir(spark, f"bench-silver-{table}")
        silver.CLEANERS[table](bronze[table], derive.stamp()).write.parquet(path)
        tables[table] = spark.read.parquet(path)
    customers, products = tables["customers"], tables["products"]
    orders, items = tables["orders"], tables["order_items"]
    window = gold.since(orders, derive.AS_OF, INCREMENTAL_DAYS)
    marts = {
        "daily_sales": lambda: gold.daily_sales(orders, items),
        "daily_sales_incr": lambda: gold.daily_sales(window, items),
        "customer_ltv": lambda: gold.customer_lifetime_value(customers, orders, items),
        "top_products": lambda: gold.top_products(products, items),
        "category_sales": lambda: gold.category_sales(products, items),
    }
    for name, mart in marts.items():
        timings[name] = seconds(lambda: drain(mart()))
    return timings


def once(run) -> float:
    start = time.perf_counter()
    run()
    return round(time.perf_counter() - start, 3)


def written(spark: SparkSession) -> dict[str, float]:
    env, timings = environment("prod", scratch_dir(spark, "bench-lake")), {}
    late = F.col("OrderDate") >= "2001-07-25"
    for table, rows in derive.BRONZE.items():
        first = rows(spark, SF_DIR)
        _land_at(first.filter(~late) if table == "orders" else first, f"{env.landing}/{table}/1")
    timings["refresh_first_load"] = once(lambda: medallion.refresh(spark, env))
    _land_at(derive.orders(spark, SF_DIR).filter(late), f"{env.landing}/orders/2")
    timings["refresh_last_days"] = once(lambda: medallion.refresh(spark, env))
    timings["refresh_without_news"] = once(lambda: medallion.refresh(spark, env))
    items = medallion.silver_table(spark, env, "order_items").read()
    path = scratch_dir(spark, "bench-increment")
    items.filter(F.xxhash64("order_item_id") % 100 == 0).write.parquet(path)
    merge = merge_increment(items, spark.read.parquet(path), ["order_item_id"], null_safe=True)
    timings["silver_merge"] = once(lambda: merge.write.parquet(scratch_dir(spark, "bench-merged")))
    for name in ("ingest_task", "ingest_skip_rows"):
        timings[name] = once(lambda: drain(QUERIES[name](spark, SF_DIR)))
    return timings


if __name__ == "__main__":
    main()
