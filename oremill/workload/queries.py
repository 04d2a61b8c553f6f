"""Every operator as a query over the given tables: ``name -> callable(spark, sf_dir) -> DataFrame``.

Results are returned in a form two engines agree on: dates and timestamps as ISO text, doubles to two decimals.
Queries about files and stored tables write to the shared scratch folder first and return what they read back.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce
from uuid import uuid4

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from oremill import functions as fn
from oremill import schemas
from oremill.config import IngestSpec, environment
from oremill.operators import asof, dedup, distinct_days, fingerprint, project, retract, runlog, upsert
from oremill.plans import gold, medallion, silver
from oremill.plans.ingest import RunIds, announce, run_ingest
from oremill.plans.table_load import run_table_load, upsert_table
from oremill.session import scratch_dir
from oremill.sinks import clustering, loads
from oremill.sinks.compacted import CompactedLog
from oremill.sinks.keyed import KeyedTable
from oremill.sinks.versions import VersionedTable
from oremill.sources import delimited, manifest, rejects
from oremill.streaming import dedup as stream_dedup
from oremill.streaming.incremental import ingest_new_files
from oremill.workload import derive

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
INCREMENTAL_DAYS = 7


def query(function: Query) -> Query:
    def comparable(spark: SparkSession, sf_dir: str) -> DataFrame:
        return portable(function(spark, sf_dir))

    QUERIES[function.__name__] = comparable
    return comparable


def portable(df: DataFrame) -> DataFrame:
    def convert(field: T.StructField):
        column = F.col(field.name)
        if isinstance(field.dataType, T.DateType):
            column = column.cast("string")
        elif isinstance(field.dataType, (T.TimestampType, T.TimestampNTZType)):
            column = F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        elif isinstance(field.dataType, T.DoubleType):
            column = F.round(column, 2)
        return column.alias(field.name)

    return df.select(*[convert(field) for field in df.schema.fields])


def _silver(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return silver.CLEANERS[table](derive.BRONZE[table](spark, sf_dir), derive.stamp())


def _since(spark: SparkSession, sf_dir: str) -> DataFrame:
    return gold.since(_silver(spark, sf_dir, "orders"), derive.AS_OF, INCREMENTAL_DAYS)


# --- cleaned tables -------------------------------------------------------------------------------------------


@query
def silver_customers(spark, sf_dir):
    return _silver(spark, sf_dir, "customers")


@query
def silver_products(spark, sf_dir):
    return _silver(spark, sf_dir, "products")


@query
def silver_orders(spark, sf_dir):
    return _silver(spark, sf_dir, "orders")


@query
def silver_order_items(spark, sf_dir):
    return _silver(spark, sf_dir, "order_items")


# --- marts ----------------------------------------------------------------------------------------------------


@query
def gold_daily_sales(spark, sf_dir):
    return gold.daily_sales(_silver(spark, sf_dir, "orders"), _silver(spark, sf_dir, "order_items"))


@query
def gold_daily_sales_incr(spark, sf_dir):
    return gold.daily_sales(_since(spark, sf_dir), _silver(spark, sf_dir, "order_items"))


@query
def gold_customer_ltv(spark, sf_dir):
    return gold.customer_lifetime_value(*[_silver(spark, sf_dir, t) for t in ("customers", "orders", "order_items")])


@query
def gold_top_products(spark, sf_dir):
    return gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))


@query
def gold_top_products_k(spark, sf_dir):
    mart = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    # Rounded first, so that the order does not hang on the last bits of a floating-point sum.
    return gold.top_products_report(portable(mart), 10)


@query
def gold_category_sales(spark, sf_dir):
    return gold.category_sales(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))


@query
def gold_ltv_affected_keys(spark, sf_dir):
    tables = [_silver(spark, sf_dir, t) for t in ("customers", "orders", "order_items")]
    return gold.lifetime_value_of_changed(*tables, _since(spark, sf_dir))


# --- upserts --------------------------------------------------------------------------------------------------


def _stale_daily_sales(spark, sf_dir):
    """The mart as some days ago, with totals that are out of date."""
    days = gold.daily_sales(_silver(spark, sf_dir, "orders"), _silver(spark, sf_dir, "order_items"))
    return days.filter(F.col("order_date") < F.date_sub(F.lit(derive.AS_OF), 3)).select(
        "order_date", F.lit(0).cast("long").alias("total_orders"), F.lit(0.0).alias("total_sales")
    )


def _stale_top_products(spark, sf_dir):
    """A target with every priced product at zero, and discontinued ones the source no longer knows."""
    known = _silver(spark, sf_dir, "products")
    zero = [F.lit(0).cast("long").alias("total_quantity"), F.lit(0.0).alias("total_revenue")]
    priced = known.filter("price IS NOT NULL").select("product_id", "product_name", *zero)
    return priced.union(known.select(F.concat(F.lit("OLD-"), "product_id"), "product_name", *zero))


def _stale_ltv(spark, sf_dir):
    known = _silver(spark, sf_dir, "customers").filter("signup_date IS NOT NULL")
    zero = [F.lit(0).cast("long").alias("total_orders"), F.lit(0.0).alias("lifetime_value")]
    return known.select("customer_id", F.lit("?").alias("full_name"), *zero)


@query
def upsert_daily_sales(spark, sf_dir):
    source = gold.daily_sales(_since(spark, sf_dir), _silver(spark, sf_dir, "order_items"))
    return upsert.upsert(_stale_daily_sales(spark, sf_dir), source, ["order_date"])


@query
def upsert_daily_sales_window(spark, sf_dir):
    source = gold.daily_sales(_since(spark, sf_dir), _silver(spark, sf_dir, "order_items"))
    inside = F.col("order_date") >= F.date_sub(F.lit(derive.AS_OF), INCREMENTAL_DAYS)
    return upsert.replace_window(_stale_daily_sales(spark, sf_dir), source, inside)


@query
def upsert_customer_ltv(spark, sf_dir):
    source = gold.customer_lifetime_value(*[_silver(spark, sf_dir, t) for t in ("customers", "orders", "order_items")])
    return upsert.upsert(_stale_ltv(spark, sf_dir), source, ["customer_id"])


@query
def upsert_top_products(spark, sf_dir):
    source = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    return upsert.upsert(_stale_top_products(spark, sf_dir), source, ["product_id"])


@query
def upsert_since_watermark(spark, sf_dir):
    """The first records of customers are stored; later records are found by ``ingest_ts`` and take their place."""
    records = derive.customers(spark, sf_dir)
    stored = records.filter(F.col("ingest_ts") < F.lit("2024-01-03").cast("timestamp"))
    return upsert.upsert_since_watermark(stored, records, ["CustomerID"], "ingest_ts")


@query
def upsert_table_load(spark, sf_dir):
    """A versioned table brought forward twice from a growing source; the third load finds nothing new."""
    records = derive.customers(spark, sf_dir)
    table = VersionedTable(spark, scratch_dir(spark, "customers"))
    early = records.filter(F.col("ingest_ts") < F.lit("2024-01-03").cast("timestamp"))
    counts = [upsert_table(rows, table, ["CustomerID"], "ingest_ts") for rows in (early, records, records)]
    return table.read().select("*", *[F.lit(r.source_count).cast("long").alias(f"load_{n}") for n, r in enumerate(counts, 1)])


@query
def merge_increment(spark, sf_dir):
    stored = _stale_top_products(spark, sf_dir)
    mart = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    return upsert.merge_increment(stored, loads.materialize(mart, "increment"), ["product_id"])


@query
def upsert_daily_sales_partitions(spark, sf_dir):
    """The mart stored by month; a refresh rewrites the months of its window and reads no other."""
    month = F.date_format("order_date", "yyyy-MM").alias("month")
    target = scratch_dir(spark, "daily-sales")
    loads.replace_partitions(_stale_daily_sales(spark, sf_dir).select("*", month), target, ["month"])
    source = gold.daily_sales(_since(spark, sf_dir), _silver(spark, sf_dir, "order_items"))
    first = F.date_format(F.date_sub(F.lit(derive.AS_OF), INCREMENTAL_DAYS), "yyyy-MM")
    stored = spark.read.parquet(target).filter(F.col("month") >= first)
    state = upsert.upsert(stored.drop("month"), source, ["order_date"]).select("*", month)
    loads.replace_partitions(loads.materialize(state, "months"), target, ["month"])
    return spark.read.parquet(target).drop("month")


@query
def snapshot_read(spark, sf_dir):
    """Both versions of a mart after an upsert: the state before it can still be read."""
    table = VersionedTable(spark, scratch_dir(spark, "mart"))
    first = table.commit(_stale_top_products(spark, sf_dir))
    mart = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    second = table.upsert(mart, ["product_id"])
    states = [table.read(n).withColumn("version", F.lit(n).cast("long")) for n in (first, second)]
    return states[0].unionByName(states[1])


def _upserted_parts(stale: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """A mart stored in parts and brought forward twice: by half of the new rows, then by the others."""
    table = KeyedTable(stale.sparkSession, scratch_dir(stale.sparkSession, "mart-parts"), [key], buckets=16)
    table.commit(stale)
    mart = loads.materialize(source, "mart")
    half = F.xxhash64(key) % 2 == 0
    for some in (mart.filter(half), mart.filter(~half)):
        table.upsert(some)
    return table.read()


@query
def upsert_customer_ltv_parts(spark, sf_dir):
    source = gold.customer_lifetime_value(*[_silver(spark, sf_dir, t) for t in ("customers", "orders", "order_items")])
    return _upserted_parts(_stale_ltv(spark, sf_dir), source, "customer_id")


@query
def upsert_top_products_parts(spark, sf_dir):
    source = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    return _upserted_parts(_stale_top_products(spark, sf_dir), source, "product_id")


@query
def table_changes(spark, sf_dir):
    """What an upsert did to a stored mart, row by row: what went and what came."""
    table = KeyedTable(spark, scratch_dir(spark, "mart-changes"), ["product_id"], buckets=16)
    first = table.commit(_stale_top_products(spark, sf_dir))
    mart = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    return table.changes(first, table.upsert(portable(mart)))


@query
def follow_changes(spark, sf_dir):
    """Revenue by product kept by changes: a third of the items comes later, and a third of the first goes again."""
    items = loads.materialize(_silver(spark, sf_dir, "order_items"), "items")
    late, gone = F.col("order_item_id").endswith("7"), F.col("order_item_id").endswith("3")
    measures = ("n_items", {"quantity": F.col("quantity")}, {"value": F.col("quantity") * F.col("price_per_unit")})
    kept = loads.materialize(retract.summed(items.filter(~late), ["product_id"], *measures), "kept")
    changes = retract.net(retract.signed(items.filter(gone), items.filter(late)))
    sums = retract.add_up(kept, retract.summed(changes, ["product_id"], *measures), ["product_id"], "n_items")
    return sums.select("product_id", "n_items", retract.value_of("quantity", "long").alias("total_quantity"), retract.value_of("value", "double").alias("total_revenue"))


@query
def gold_daily_sales_by_day(spark, sf_dir):
    """The incremental mart from items stored by the day of their order: only the window's days are read."""
    table = KeyedTable(spark, scratch_dir(spark, "items-by-day"), ["order_item_id"], by="order_date")
    orders = loads.materialize(_silver(spark, sf_dir, "orders"), "orders")
    table.commit(_silver(spark, sf_dir, "order_items").join(orders.select("order_id", "order_date"), "order_id", "left"))
    return gold.daily_sales_by_day(gold.since(orders, derive.AS_OF, INCREMENTAL_DAYS), table.read())


# --- projections, casts, dedup --------------------------------------------------------------------------------


@query
def rename_columns(spark, sf_dir):
    return project.rename_columns(derive.order_items(spark, sf_dir), silver.RENAMES["order_items"])


@query
def align_schema(spark, sf_dir):
    """Text columns cast to the declared types, in the declared order; a column too many is dropped."""
    loose = derive.orders(spark, sf_dir).select(
        F.lit("dropped").alias("extra"),
        F.col("ingest_ts").alias("updated_ts"),
        F.col("OrderStatus").alias("order_status"),
        F.col("OrderDate").alias("order_date"),
        F.col("CustomerID").alias("customer_id"),
        F.col("OrderID").alias("order_id"),
    )
    return project.align_to_schema(loose, schemas.SILVER["orders"])


@query
def guarded_int(spark, sf_dir):
    rows = derive.order_items(spark, sf_dir)
    return rows.select("OrderItemID", "Quantity", fn.guarded_int("Quantity").alias("quantity_int"))


@query
def guarded_double(spark, sf_dir):
    rows = derive.products(spark, sf_dir)
    return rows.select("ProductID", "Price", fn.guarded_double("Price").alias("price_double"))


@query
def date_parse(spark, sf_dir):
    rows = derive.customers(spark, sf_dir)
    return rows.select("CustomerID", "SignUpDate", fn.parse_date("SignUpDate").alias("signup_date"))


@query
def audit_stamp(spark, sf_dir):
    rows = derive.products(spark, sf_dir).select("ProductID", "ProductName")
    return project.stamp(rows, "updated_ts", derive.stamp())


@query
def dedup_by_key(spark, sf_dir):
    return dedup.dedup_by_key(derive.customers(spark, sf_dir), ["CustomerID"])


@query
def orders_with_null_status(spark, sf_dir):
    return silver.silver_orders(derive.orders(spark, sf_dir), derive.stamp(), keep_null_status=True)


# --- run log --------------------------------------------------------------------------------------------------


@query
def active_tasks(spark, sf_dir):
    return runlog.active_tasks(derive.task_metadata(spark, sf_dir))


@query
def active_tasks_of_group(spark, sf_dir):
    return runlog.active_tasks(derive.task_metadata(spark, sf_dir), "click", "G1")


@query
def watermark_per_task(spark, sf_dir):
    return runlog.watermark_per_task(derive.task_control(spark, sf_dir))


@query
def watermark_of_compacted_log(spark, sf_dir):
    """The log arrives in eleven parts, with a snapshot after every third; watermarks and last files of what readers see."""
    rows = loads.materialize(derive.task_control(spark, sf_dir), "task-log")
    log = CompactedLog(spark, scratch_dir(spark, "compacted-log"), rows.schema, runlog.deciding_rows, every=3)
    for part in range(11):
        log.append(rows.filter(F.pmod(F.xxhash64("task_run_id"), F.lit(11)) == part))
    seen = log.read()
    return runlog.watermark_per_task(seen).join(runlog.last_file_per_task(seen, F.col("job_name")), runlog.TASK)


@query
def stream_without_repeats(spark, sf_dir):
    """Events in three waves by time; every seventh comes twice, and every tenth of the first wave with the last one."""
    path = scratch_dir(spark, "stream-dedup")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select("event_id", "event_type", F.unix_micros(F.col("ts").cast("timestamp")).alias("micros"))
    span = events.agg(F.min("micros").alias("first"), F.max("micros").alias("last")).first()
    wave = F.least(F.lit(2), F.expr(f"(micros - {span['first']}) * 3 DIV greatest(1, {span['last'] - span['first']})"))
    held = F.when((wave == 0) & (F.col("event_id") % 10 == 3), 2).otherwise(wave)
    copies = F.explode(F.sequence(F.lit(0), F.when(F.col("event_id") % 7 == 0, 1).otherwise(0))).alias("copy")
    rows = loads.materialize(events.select("event_id", "event_type", "micros", held.cast("bigint").alias("wave"), copies).drop("copy"), "event-waves")
    schema = schemas.declared("event_id BIGINT, event_type STRING, micros BIGINT, ingest_batch BIGINT")
    for number in range(3):
        loads.replace_partitions(rows.filter(F.col("wave") == number).withColumnRenamed("wave", "ingest_batch"), f"{path}/landed", ["ingest_batch"])
        stream_dedup.accept_new_rows(spark, f"{path}/landed", schema, f"{path}/out", ["event_id"], F.timestamp_micros("micros"), "1 HOUR")
    accepted = stream_dedup.accepted_rows(spark, f"{path}/out", schema).withColumn("state", F.lit("accepted"))
    late = stream_dedup.late_rows(spark, f"{path}/out", schema).withColumn("state", F.lit("late"))
    return accepted.unionByName(late).groupBy("event_type", "state").agg(F.count(F.lit(1)).alias("n_rows"), F.sum("event_id").alias("ids"))


@query
def last_file_per_task(spark, sf_dir):
    return runlog.last_file_per_task(derive.task_control(spark, sf_dir), F.col("job_name"))


@query
def restart_set(spark, sf_dir):
    return runlog.restart_set(derive.task_control(spark, sf_dir), derive.task_metadata(spark, sf_dir))


@query
def tasks_to_start(spark, sf_dir):
    log, tasks = derive.task_control(spark, sf_dir), derive.task_metadata(spark, sf_dir)
    return runlog.tasks_to_start(log, tasks, "error", "R1", "G1")


@query
def run_rank(spark, sf_dir):
    return runlog.run_rank(derive.task_control(spark, sf_dir))


@query
def reconcile_rows(spark, sf_dir):
    rows = runlog.reconcile(derive.task_control(spark, sf_dir))
    return rows.select("task_run_id", "source_count", "target_count", "load_status", "load_message")


@query
def reconcile_loads(spark, sf_dir):
    return runlog.reconcile_summary(derive.task_control(spark, sf_dir))


@query
def task_state_latest(spark, sf_dir):
    rows = runlog.task_state_latest(derive.task_control(spark, sf_dir))
    return rows.select("job_name", "parent_run_id", "task_name", "task_run_id", "status", "execution_start_ts")


@query
def run_log_rows(spark, sf_dir):
    rows = runlog.run_log_rows(derive.task_control(spark, sf_dir), derive.stamp())
    counts = [F.col(c).cast("long").alias(c) for c in ("records_in", "records_out")]
    return rows.select("job_id", "parent_run_id", "task_run_id", "create_dt", "primary_message", *counts)


@query
def run_report(spark, sf_dir):
    return runlog.run_report(derive.task_control(spark, sf_dir))


@query
def run_durations(spark, sf_dir):
    rows = derive.task_control(spark, sf_dir)
    start, end = F.col("execution_start_ts"), F.col("execution_end_ts")
    spent = fn.hours_minutes_seconds((F.unix_micros(end) - F.unix_micros(start)) / 1000)
    day = F.date_format(start, "yyyy-MM-dd")
    return rows.select(
        "task_run_id", fn.elapsed_minutes(start, end).alias("minutes"), spent.alias("spent"),
        fn.with_time_of_day(day, end).alias("day_with_time"),
    ).select("task_run_id", "minutes", "day_with_time", "spent.hours", F.col("spent.minutes").alias("whole_minutes"),
             "spent.seconds")


@query
def procedure_log(spark, sf_dir):
    rows = derive.task_control(spark, sf_dir)
    run = F.col("task_run_id").cast("long")
    kind = F.when(run % 3 == 0, " Progress").when(run % 3 == 1, "success").otherwise("FAIL")
    given = F.when(run % 10 == 0, "done").otherwise("")
    message = fn.procedure_message(
        kind, given, F.col("job_id"), run % 100, F.col("job_name"), F.col("task_name"), F.col("source_count"),
        fn.elapsed_minutes(F.col("execution_start_ts"), F.col("execution_end_ts")),
    )
    return rows.select("task_run_id", message.alias("primary_message"))


@query
def retention_filter(spark, sf_dir):
    rows = derive.task_control(spark, sf_dir).select("task_run_id", "execution_start_ts")
    return runlog.retention_filter(rows, F.lit("2024-02-10").cast("timestamp"), "execution_start_ts", months=1)


# --- files ----------------------------------------------------------------------------------------------------


@query
def file_lineage(spark, sf_dir):
    path = F.col("path")
    return derive.file_listing(spark, sf_dir).select(
        "path", "size", fn.file_name(path).alias("FILE_NAME"), fn.file_timestamp(path).alias("FILE_TS")
    )


@query
def file_times(spark, sf_dir):
    """The time in each file's name, in one form for daily files and another for monthly ones."""
    text = fn.file_timestamp(F.col("path"))
    form = F.when(F.col("size") % 3 == 0, F.substring(text, 1, 8)).otherwise(text)
    return derive.file_listing(spark, sf_dir).select("size", form.alias("FILE_TS"), fn.file_time(form).alias("file_time"))


@query
def file_runs(spark, sf_dir):
    """Each file with the run that it came in, of every third event's run: ties, gaps between runs, and files before any."""
    runs = derive.task_control(spark, sf_dir).filter(F.col("task_run_id").cast("long") % 3 == 0)
    found = asof.attribute_files(derive.file_listing(spark, sf_dir), runs)
    return found.select("size", "job_name", "task_name", "task_run_id", "in_run")


@query
def distinct_customers_by_month(spark, sf_dir):
    """Customers with an order, by month and over all time, from bitmaps kept by day and brought forward once."""
    orders = loads.materialize(_silver(spark, sf_dir, "orders"), "orders")
    early = F.col("order_date") < F.lit("2001-07-25").cast("date")
    numbers, kept = None, None
    for some in (orders.filter(early), orders.filter(~early)):
        numbers = loads.materialize(distinct_days.numbered(some, "customer_id", numbers), "customer-numbers")
        days = distinct_days.bitmaps(some.join(numbers, "customer_id"), ["order_date"])
        kept = days if kept is None else distinct_days.add_days(kept, days, ["order_date"])
    kept = loads.materialize(kept, "customer-days")
    spans = [F.date_format("order_date", "yyyy-MM"), F.lit("all")]
    found = [distinct_days.counted(kept.withColumn("span", span), ["span"], "customers") for span in spans]
    return found[0].unionByName(found[1])


@query
def latest_file(spark, sf_dir):
    return manifest.latest_file(derive.file_listing(spark, sf_dir), "202401", by=("job_name",))


@query
def latest_file_monthly(spark, sf_dir):
    return manifest.latest_file_containing(derive.file_listing(spark, sf_dir), "monthly", by=("job_name",))


@query
def new_files_since(spark, sf_dir):
    marks = runlog.watermark_per_task(derive.task_control(spark, sf_dir))
    files = derive.file_listing(spark, sf_dir)
    return manifest.new_files_since(files, marks, ("job_name", "task_name")).select("path", "size", "modified")


RAW_FILES = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "escape": '"', "header": True}


def _land_at(rows: DataFrame, path: str, **options) -> None:
    """Write raw rows, without their ``ingest_ts``, as header CSV files with blanks and quotes kept."""
    rows.drop("ingest_ts").write.options(**RAW_FILES, **options).csv(path)


def _land(rows: DataFrame, label: str, **options) -> str:
    path = scratch_dir(rows.sparkSession, label)
    _land_at(rows, path, **options)
    return path


def _land_feeds(spark: SparkSession, sf_dir: str) -> str:
    """Raw orders in one file per feed of at most a few thousand orders, in key order, and a file with no rows."""
    rows = derive.orders_with_key(spark, sf_dir).drop("ingest_ts")
    rows = rows.withColumn("feed", F.floor(F.col("o_orderkey") / derive.ORDERS_PER_FEED).cast("int"))
    path = scratch_dir(spark, "feeds")
    writer = rows.repartition("feed").sortWithinPartitions("feed", "o_orderkey").drop("o_orderkey").write
    writer.partitionBy("feed").options(**RAW_FILES).csv(path)
    _land_at(rows.drop("o_orderkey", "feed").filter("false"), f"{path}/feed=-1")
    return path


def _feed(path: str = "path"):
    return F.regexp_extract(F.col(path), "feed=(-?[0-9]+)", 1).cast("int").alias("feed")


@query
def ingest_csv_schema(spark, sf_dir):
    """The header says UnitPrice, the declared schema Price; they meet by position."""
    raw = derive.products(spark, sf_dir).withColumnRenamed("Price", "UnitPrice")
    rows = delimited.read_with_schema(spark, _land(raw, "products"), schemas.BRONZE["products"])
    return project.stamp(rows, "ingest_ts", derive.stamp())


@query
def ingest_null_marker(spark, sf_dir):
    """Landed with a marker of NULL, and read with it: NULL and empty text both survive."""
    path = _land(derive.products(spark, sf_dir), "products", nullValue="\\N")
    return delimited.read_quoted(spark, path, null_value="\\N")


@query
def ingest_delimited(spark, sf_dir):
    path = _land(derive.customers(spark, sf_dir), "customers", sep="|")
    return delimited.read_delimited(spark, path, "csv", True, "|")


@query
def ingest_rejects(spark, sf_dir):
    """Raw orders as lines, some with a field too many, too few or an open quote: rows and rejects."""
    raw = derive.orders_with_key(spark, sf_dir)
    fields = [F.coalesce(F.col(c), F.lit("")) for c in ("OrderID", "CustomerID", "OrderDate", "OrderStatus")]
    fault = (
        F.when(F.col("o_orderkey") % 11 == 0, F.concat_ws(",", *fields, F.lit("x")))
        .when(F.col("o_orderkey") % 13 == 0, F.concat_ws(",", *fields[:2]))
        .when(F.col("o_orderkey") % 17 == 0, F.concat(F.concat_ws(",", *fields[:3]), F.lit(',"'), fields[3]))
        .otherwise(F.concat_ws(",", *fields[:3], F.concat(F.lit('"'), fields[3], F.lit('"'))))
    )
    path = scratch_dir(spark, "faulty")
    raw.select(fault.alias("value")).write.text(path)
    payload = schemas.payload(schemas.BRONZE["orders"])
    scan = rejects.read_with_rejects(spark, path, payload, header=False)
    nothing = F.lit(None).cast("string")
    rows = scan.rows.select(*payload.names, *[nothing.alias(c) for c in ("line", "reason")])
    return rows.unionByName(scan.rejects.select(*[nothing.alias(c) for c in payload.names], "line", "reason"))


@query
def ingest_quoted(spark, sf_dir):
    """Quotes, separators and blanks inside fields survive."""
    rows = derive.products(spark, sf_dir).select(
        "ProductID", F.concat(F.lit(' the "'), "ProductName", F.lit('", new, 12"')).alias("Label"), "Category"
    )
    return delimited.read_quoted(spark, _land(rows, "quoted"))


@query
def ingest_skip_rows(spark, sf_dir):
    path = _land_feeds(spark, sf_dir)
    scan = delimited.read_delimited(spark, path)
    return delimited.skip_leading_rows(scan, 3).select("feed", "OrderID", "CustomerID", "OrderDate", "OrderStatus")


@query
def file_manifest(spark, sf_dir):
    files = manifest.file_manifest(spark, _land_feeds(spark, sf_dir), "*.csv", oldest_first=True)
    files = files.withColumn("place", F.monotonically_increasing_id())
    # Sorted rows keep their order in the ids, so each file but the last is no newer than the next.
    later = files.select((F.col("place") - 1).alias("place"), F.struct("modified", "path").alias("next"))
    ordered = F.coalesce(F.struct("modified", "path") < F.col("next"), F.lit(True))
    named = F.col("path").endswith(F.col("name")).alias("named")
    return files.join(later, "place", "left").select(_feed(), (F.col("size") > 0).alias("filled"), named, ordered.alias("in_order"))


@query
def per_file_counts(spark, sf_dir):
    path = _land_feeds(spark, sf_dir)
    files = manifest.file_manifest(spark, path, "*.csv")
    counts = manifest.counts_per_file(files, delimited.read_delimited(spark, path))
    return counts.select(_feed(), "row_count")


@query
def ingest_incremental(spark, sf_dir):
    """Two waves of files, each followed by two runs: every row arrives once."""
    rows = derive.customers(spark, sf_dir)
    root = scratch_dir(spark, "stream")
    for wave in ("2024-01-02", "2024-01-03"):
        _land_at(rows.filter(F.col("ingest_ts") == F.lit(wave).cast("timestamp")), f"{root}/landing/{wave}")
        for _ in range(2):
            ingest_new_files(
                spark, f"{root}/landing", schemas.payload(schemas.BRONZE["customers"]), f"{root}/bronze",
                f"{root}/checkpoint", derive.stamp(),
            )
    rows = spark.read.parquet(f"{root}/bronze")
    wave = F.regexp_extract("FILE_NAME", "landing/(.{10})/", 1)
    return rows.withColumns({"wave": wave, "has_file_ts": F.col("FILE_TS").isNotNull()}).drop("FILE_NAME", "FILE_TS")


@query
def ingest_task(spark, sf_dir):
    """A task run from its metadata row, twice: the files are taken by the first run, the second finds no new ones."""
    root = scratch_dir(spark, "task")
    landed = _land_feeds(spark, sf_dir)
    task = IngestSpec("retail", "orders", landed, f"{root}/bronze/orders")
    states = [run_ingest(spark, task, f"{root}/control", RunIds("J1", f"R{n}", f"T{n}")) for n in (1, 2)]
    rows = spark.read.parquet(task.target_path).withColumn("states", F.lit(" ".join(states)))
    return rows.select("OrderID", "CustomerID", "OrderDate", "OrderStatus", _feed("FILE_NAME"), "states")


# --- loads ----------------------------------------------------------------------------------------------------


@query
def load_append(spark, sf_dir):
    target = scratch_dir(spark, "append")
    rows = derive.products(spark, sf_dir)
    for _ in range(2):
        loads.append(rows, target)
    return loads.read_target(spark, target)


@query
def load_overwrite(spark, sf_dir):
    target = scratch_dir(spark, "overwrite")
    loads.overwrite(derive.customers(spark, sf_dir), target)
    loads.overwrite(derive.products(spark, sf_dir), target)
    return loads.read_target(spark, target)


def _loaded(spark, rows, load_type) -> DataFrame:
    target = scratch_dir(spark, "load")
    loads.load(rows, target, load_type, user="loader", at=derive.stamp(), task_name="T1")
    return loads.read_target(spark, target)


@query
def load_append_audit(spark, sf_dir):
    return _loaded(spark, derive.products(spark, sf_dir).drop("ingest_ts"), "APPEND")


@query
def load_overwrite_audit(spark, sf_dir):
    """Rows read from files, with the feed they came from."""
    scan = delimited.with_lineage(delimited.read_quoted(spark, _land_feeds(spark, sf_dir)))
    rows = _loaded(spark, scan.drop("feed"), "OVERWRITE")
    return rows.withColumn("feed", _feed("FILE_NAME")).drop("FILE_NAME")


@query
def load_overwrite_load_by(spark, sf_dir):
    return _loaded(spark, derive.orders(spark, sf_dir).drop("ingest_ts"), "OVERWRITE_ONLY_LOAD_BY")


@query
def load_crud_audit(spark, sf_dir):
    return _loaded(spark, derive.customers(spark, sf_dir).drop("ingest_ts"), "UPSERT")


@query
def load_from_query(spark, sf_dir):
    target = scratch_dir(spark, "from-query")
    mart = gold.top_products(_silver(spark, sf_dir, "products"), _silver(spark, sf_dir, "order_items"))
    loads.load_from_query(mart, target, "OVERWRITE")
    loads.load_from_query(mart, target, "APPEND")
    return loads.read_target(spark, target)


@query
def load_counts(spark, sf_dir):
    """What each bronze load counted while writing."""
    results = {
        table: loads.load(rows(spark, sf_dir), scratch_dir(spark, table), "APPEND")
        for table, rows in derive.BRONZE.items()
    }
    return spark.createDataFrame(
        [(table, r.source_count, r.target_count, r.status) for table, r in results.items()],
        "table_name STRING, source_count BIGINT, target_count BIGINT, status STRING",
    )


def _layers(spark: SparkSession, sf_dir: str) -> dict[str, dict[str, DataFrame]]:
    """Rows for every declared table; silver, and the sums of items that marts share, stored once for the marts."""
    bronze = {table: rows(spark, sf_dir) for table, rows in derive.BRONZE.items()}
    clean = {table: loads.materialize(silver.CLEANERS[table](rows, derive.stamp()), table) for table, rows in bronze.items()}
    customers, products, orders, items = (clean[t] for t in ("customers", "products", "orders", "order_items"))
    by_order = loads.materialize(gold.order_totals(items), "order-totals")
    by_product = loads.materialize(gold.product_totals(items), "product-totals")
    marts = {
        "daily_sales": gold.daily_sales(orders, items, by_order),
        "customer_lifetime_value": gold.customer_lifetime_value(customers, orders, items, by_order),
        "top_products": gold.top_products(products, items, by_product),
        "category_sales": gold.category_sales(products, items, by_product),
    }
    log, tasks = derive.task_control(spark, sf_dir), derive.task_metadata(spark, sf_dir)
    missing = {f.name: F.lit(None) for f in schemas.CONTROL["ingest_metadata"].fields if f.name not in tasks.columns}
    control = {
        "task_control": log,
        "task_run_log": runlog.run_log_rows(log, derive.stamp()),
        "ingest_metadata": tasks.withColumns(missing),
    }
    return {"bronze": bronze, "silver": clean, "gold": marts, "control": control}


@query
def truncate_layer(spark, sf_dir):
    """Rows of each bronze, silver and gold table before and after it is emptied."""
    prefix = _catalog_prefix()
    layers = _layers(spark, sf_dir)
    names = {}
    for layer in ("bronze", "silver", "gold"):
        names[layer] = schemas.declare_layer(spark, layer, prefix, scratch_dir(spark, "catalog"))
        for table, rows in layers[layer].items():
            rows.write.mode("append").insertInto(f"{prefix}{layer}.{table}")
    every = [name for some in names.values() for name in some]
    before = loads.materialize(_table_counts(spark, every, "rows_before"), "counts")
    for layer in names:
        schemas.truncate_layer(spark, layer, prefix)
    return before.join(_table_counts(spark, every, "rows_after"), ["layer", "table_name"])


def _catalog_prefix() -> str:
    return f"oremill_{uuid4().hex[:12]}_"


def _table_counts(spark: SparkSession, names: list[str], column: str) -> DataFrame:
    def count(name: str) -> DataFrame:
        counted = spark.table(name).agg(F.count(F.lit(1)).alias(column))
        database, table = name.split(".")
        return counted.select(F.lit(database.rsplit("_", 1)[1]).alias("layer"), F.lit(table).alias("table_name"), column)

    return reduce(DataFrame.union, [count(name) for name in names])


def _metadata(spark: SparkSession, rows: list[dict]) -> list:
    schema = schemas.CONTROL["ingest_metadata"]
    return spark.createDataFrame([tuple(r.get(name) for name in schema.names) for r in rows], schema).collect()


@query
def table_loads(spark, sf_dir):
    """Loads from table to table as three metadata rows ask for them, each run twice over a growing source."""
    root = scratch_dir(spark, "tables")
    records = derive.customers(spark, sf_dir)
    common = {"source_schema": "bronze", "source_table": "customers", "target_schema": "out"}
    count = "SELECT Country AS name, count(*) AS amount FROM {source} GROUP BY Country"
    cities = "SELECT CustomerID AS name, City AS city, ingest_ts FROM {source}"
    rows = _metadata(spark, [
        {**common, "load_type": "append", "target_table": "appended", "load_query": count},
        {**common, "load_type": "OVERWRITE", "target_table": "overwritten", "load_query": count},
        {**common, "load_type": "UPSERT", "target_table": "merged", "load_query": cities, "merge_cols": "ingest_ts"},
    ])
    for until in ("2024-01-03", "2024-01-04"):
        loads.overwrite(records.filter(F.col("ingest_ts") < F.lit(until).cast("timestamp")), f"{root}/bronze/customers")
        results = [run_table_load(spark, row, root, ["name"]) for row in rows]
    merged = VersionedTable(spark, f"{root}/out/merged").read()
    counted = [spark.read.parquet(f"{root}/out/{name}").select(F.lit(name).alias("target"), "name", "amount", F.lit(None).cast("string").alias("city")) for name in ("appended", "overwritten")]
    states = " ".join(r.status for r in results)
    every = counted[0].unionByName(counted[1]).unionByName(merged.select(F.lit("merged").alias("target"), "name", F.lit(None).cast("long").alias("amount"), "city"))
    return every.withColumn("states", F.lit(states))


@query
def reconcile_contents(spark, sf_dir):
    """A target with as many rows as its source in which rows are lost, doubled and changed: which keys differ, and how."""
    source = loads.materialize(derive.orders_with_key(spark, sf_dir).drop("ingest_ts"), "source")
    n = F.col("o_orderkey")
    changed = source.withColumn("OrderStatus", F.when(n % 97 == 0, "lost in the load").otherwise(F.col("OrderStatus")))
    target = changed.filter(n % 89 != 0).unionByName(source.filter(n % 83 == 0))
    return fingerprint.differences(source, loads.materialize(target, "target"), ["OrderID"])


@query
def clustered_read(spark, sf_dir):
    """A log clustered by three columns, and the rows of a range of two of them, read from the files that may hold such."""
    log = loads.materialize(derive.task_control(spark, sf_dir), "log")
    path = scratch_dir(spark, "clustered")
    clustering.write_clustered(log, path, ["job_name", "task_name", "source_count"], 32)
    wanted = {"job_name": ("click", "purchase"), "source_count": (250, 400)}
    return clustering.read_clustered(spark, path, wanted).select("job_name", "task_name", "task_run_id", "source_count", "status")


@query
def not_started(spark, sf_dir):
    """The active tasks of a run, announced in its control log."""
    root = scratch_dir(spark, "announced")
    announce(runlog.active_tasks(derive.task_metadata(spark, sf_dir)), root, "J1", "R1")
    return spark.read.parquet(f"{root}/task_control").select("job_name", "job_id", "parent_run_id", "task_name", "status")


@query
def materialize(spark, sf_dir):
    tasks = runlog.active_tasks(derive.task_metadata(spark, sf_dir))
    return loads.materialize(tasks.withColumn("running_status_tracker", F.lit("NOT STARTED")), "tasks")


@query
def schema_conformance(spark, sf_dir):
    """Non-NULL values per column of every declared table, with the type that its rows take in it."""
    parts = []
    layers = _layers(spark, sf_dir)
    for layer, table, schema in [(n, t, s) for n, some in schemas.LAYERS.items() for t, s in some.items()]:
        rows = project.align_to_schema(layers[layer][table], schema)
        counts = rows.agg(*[F.count(f.name).alias(f.name) for f in schema.fields])
        found = {f.name: f.dataType.simpleString() for f in rows.schema.fields}
        entries = [
            F.struct(
                F.lit(name).alias("column_name"), F.lit(found[name]).alias("data_type"), F.col(name).alias("filled")
            )
            for name in schema.names
        ]
        named = [F.lit(layer).alias("layer"), F.lit(table).alias("table_name")]
        parts.append(counts.select(*named, F.explode(F.array(*entries)).alias("e")))
    return reduce(DataFrame.union, parts).select("layer", "table_name", "e.column_name", "e.data_type", "e.filled")


@query
def medallion_refresh(spark, sf_dir):
    """Files to marts in waves, and a last refresh that finds nothing new.

    Later waves bring changed customers, the orders of the last days and items that arrive late, for orders of any day,
    while the clock steps back.  They reach the marts by way of the incremental forms: only new bronze rows are cleaned,
    only what they touch is recomputed.
    """
    env = environment("prod", scratch_dir(spark, "lake"))
    raw = {table: rows(spark, sf_dir) for table, rows in derive.BRONZE.items()}
    late = {
        "customers": F.col("ingest_ts") >= F.lit("2024-01-03").cast("timestamp"),
        "orders": F.col("OrderDate") >= "2001-07-25",
        "order_items": F.col("OrderItemID").endswith("7"),
    }
    for wave, day in ((1, 5), (2, 4), (3, 6)):
        for table, rows in raw.items():
            if wave == 1:
                _land_at(rows.filter(~late[table]) if table in late else rows, f"{env.landing}/{table}/wave-1")
            elif wave == 2 and table in late:
                _land_at(rows.filter(late[table]), f"{env.landing}/{table}/wave-2")
        medallion.refresh(spark, env, at=F.lit(f"2024-02-0{day}").cast("timestamp"))
    marts = {mart: medallion.mart_table(spark, env, mart).read() for mart in schemas.GOLD}
    return reduce(DataFrame.unionByName, [
        mart.select(F.lit(name).alias("mart"), F.col(schemas.KEYS[name]).cast("string").alias("mart_key"),
                    *[F.col(c).cast("double").alias(a) for c, a in zip(mart.columns[-2:], ("total", "amount"))])
        for name, mart in marts.items()
    ])


@query
def gold_daily_sales_bucketed(spark, sf_dir):
    """The mart over silver tables stored bucketed by order: neither the sum per order nor the join shuffles items."""
    prefix = _catalog_prefix()
    database = f"{prefix}silver"
    spark.sql(f"CREATE DATABASE {database} LOCATION '{scratch_dir(spark, 'catalog')}'")
    tables = {table: loads.materialize(_silver(spark, sf_dir, table), table) for table in ("orders", "order_items")}
    buckets = loads.bucket_count(list(tables.values()), "order_id", 8)
    for table, rows in tables.items():
        loads.write_bucketed(rows, f"{database}.{table}", "order_id", buckets)
    return gold.daily_sales(spark.table(f"{database}.orders"), spark.table(f"{database}.order_items"))
