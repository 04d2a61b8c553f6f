"""The refresh from raw files to marts.

Each layer is stored.  Bronze grows by the rows of new files, in numbered batches.  Silver takes over only the batches it
has not seen, writes only the parts of its tables that they touch, and notes which rows went and which came.  From there on
tables follow the changes of the tables they are derived from: items are summed by order and product, orders with such sums
by customer and day, products with such sums by category, and each of these sums is kept by adding what came and taking away
what went.  Unchanged items are not read again.

Every commit notes a mark of how far its sources had got: a batch number, or the versions of tables, never a time.  A table
whose mark still holds is left alone, so a refresh without news reads no data, and one that died half-way is completed by
running it again, whenever that is.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from oremill.config import Environment
from oremill.operators.retract import add_up, every, net, regrouped, signed, summed, value_of
from oremill.operators.upsert import matching
from oremill.plans.silver import CLEANERS
from oremill.schemas import BRONZE, GOLD, KEYS, payload
from oremill.session import sized_shuffles
from oremill.sinks.keyed import KeyedTable
from oremill.sinks.loads import materialize
from oremill.streaming.incremental import INGEST_BATCH, ingest_new_files, ingested

# Sorted inside each file, so that a filter on the column skips most pages of every file; this takes no shuffle.
SORTED_BY = {"orders": "order_date"}

# What tables derived from a silver table need to know of a row that went or came.
NOTED = {
    "customers": ["customer_id", "full_name"],
    "products": ["product_id", "product_name", "category"],
    "orders": ["order_id", "customer_id", "order_date"],
    "order_items": ["order_item_id", "order_id", "product_id", "quantity", "price_per_unit"],
}
ITEMS_BY_DAY = "items_by_day"


class Mart(KeyedTable):
    """A mart that is stored as kept sums and read as the mart."""

    def __init__(self, spark: SparkSession, path: str, keys: list[str], buckets: int, shown: Callable[[], list[Column]]):
        super().__init__(spark, path, keys, buckets)
        self.shown = shown

    def read(self, version: int | None = None, of: Iterable[str] | None = None) -> DataFrame:
        return self.sums(version, of).select(*self.keys, *self.shown())

    def sums(self, version: int | None = None, of: Iterable[str] | None = None) -> DataFrame:
        return super().read(version, of)


SHOWN = {
    "daily_sales": lambda: [F.col("n_orders").alias("total_orders"), value_of("value", "double").alias("total_sales")],
    "category_sales": lambda: [value_of("quantity", "long").alias("total_quantity"), value_of("value", "double").alias("total_revenue")],
}


def silver_table(spark: SparkSession, env: Environment, table: str) -> KeyedTable:
    return KeyedTable(spark, env.table_path("silver", table), [KEYS[table]], env.buckets, noted=NOTED[table], sorted_by=SORTED_BY.get(table))


def mart_table(spark: SparkSession, env: Environment, mart: str) -> KeyedTable:
    path, keys = env.table_path("gold", mart), [KEYS[mart]]
    return Mart(spark, path, keys, env.buckets, SHOWN[mart]) if mart in SHOWN else KeyedTable(spark, path, keys, env.buckets)


def sums_table(spark: SparkSession, env: Environment, of: str) -> KeyedTable:
    """Kept sums that marts are built from: by ``order``, ``product`` or ``customer``."""
    return KeyedTable(spark, env.table_path("gold", f"{of}_sums"), [f"{of}_id"], env.buckets)


def items_by_day(spark: SparkSession, env: Environment) -> KeyedTable:
    """The items with the day of their order, a folder for each day; items of no order have a NULL day."""
    return KeyedTable(spark, env.table_path("gold", ITEMS_BY_DAY), ["order_item_id"], by="order_date")


def _bronze(spark: SparkSession, env: Environment, table: str) -> DataFrame:
    return ingested(spark, env.table_path("bronze", table), payload(BRONZE[table]))


def load_bronze(spark: SparkSession, env: Environment, at: Column | None = None) -> dict[str, int]:
    """Append the new files of each entity's landing folder to its bronze table; rows added per table."""
    return {
        table: ingest_new_files(
            spark, f"{env.landing}/{table}", payload(schema), env.table_path("bronze", table),
            f"{env.checkpoints}/{table}", at, env.files_per_batch, env.null_value,
        )
        for table, schema in BRONZE.items()
    }


def refresh_silver_table(
    spark: SparkSession, env: Environment, table: str, at: Column | None = None, full: bool = False
) -> int | None:
    """Bring one silver table up to its bronze table; the new version, or None if nothing was new.

    Of several records of a key the one of the last batch counts, in it the one ingested last.  So a cleaned new row
    replaces the old row of its key, NULL keys like any other, and the result is that of cleaning all of bronze.  Of
    bronze only new batches are read, and of the stored table only the parts that their keys fall in.
    """
    target = silver_table(spark, env, table)
    target.alone = True
    commit = None if full else target.latest()
    bronze = _bronze(spark, env, table)
    if commit:
        bronze = bronze.filter(F.col(INGEST_BATCH) > int(commit["mark"]))
    newest = bronze.agg(F.max(INGEST_BATCH).alias("newest")).first()["newest"]
    if newest is None:
        return None
    rows = bronze.filter(F.col(INGEST_BATCH) <= newest).select(*BRONZE[table].names, INGEST_BATCH)
    state = CLEANERS[table](rows, at, newest=(INGEST_BATCH, "ingest_ts"))
    if not commit:
        return target.commit(state, f"{newest}")
    fresh = materialize(state, f"silver-{table}")
    return target.replace(fresh, fresh, f"{newest}")


def refresh_silver(
    spark: SparkSession, env: Environment, at: Column | None = None, full: bool = False
) -> dict[str, int | None]:
    return {table: refresh_silver_table(spark, env, table, at, full) for table in CLEANERS}


Tables = dict[str, DataFrame]
Versions = dict[str, int]


@dataclass(frozen=True)
class Derived:
    """A table derived from others: how it is built from all of them, and how it follows their changes.

    ``follow`` takes the changes, the versions seen and those of now, and commits with the mark given last.
    """

    target: KeyedTable
    sources: dict[str, KeyedTable]
    whole: Callable[[Tables], DataFrame]
    follow: Callable[[Tables, Versions, Versions, str], int]

    def bring_up(self, full: bool = False) -> int | None:
        """Bring the table up to its sources; the new version, or None if there was nothing to do.

        The table is built as a whole if it is new, if ``full``, or if one of its sources was stored as a whole.
        """
        now = {name: source.current() for name, source in self.sources.items()}
        mark = " ".join(f"{name}@{version}" for name, version in now.items())
        commit = self.target.latest()
        if commit and not full and commit["mark"] == mark:
            return None
        if commit and not full:
            seen = {name: int(version) for name, version in (part.split("@") for part in commit["mark"].split())}
            changes = {name: source.changes(seen[name], now[name]) for name, source in self.sources.items()}
            if all(found is not None for found in changes.values()):
                return self.follow(changes, seen, now, mark)
        return self.target.commit(self.whole({name: source.read(now[name]) for name, source in self.sources.items()}), mark)


def _kept(rows: DataFrame, of: str) -> DataFrame:
    """Kept sums of items by order or product, of items or of their changes."""
    amount = F.col("quantity") * F.col("price_per_unit")
    return summed(rows.filter(F.col(of).isNotNull()), [of], "n_items", {"quantity": F.col("quantity")}, {"value": amount})


def _add(target: KeyedTable, change: DataFrame, count: str, mark: str) -> int:
    """Add a change to the kept sums of its groups; other groups are not read where they are in other parts."""
    change = materialize(change, "change")
    touched = target.parts_of(change)
    stored = target.sums if isinstance(target, Mart) else target.read
    old = materialize(matching(stored(of=touched), change.select(*target.keys), "left_semi"), "before")
    return target.replace(change, materialize(add_up(old, change, target.keys, count), "sums"), mark, touched, old)


def _rows_of(keys: DataFrame, parts: list[str], table: KeyedTable, version: int) -> DataFrame:
    """The rows of some keys, none of them NULL, in a version: only ``parts``, those that the keys fall in, are read.

    By plain equality, so that a join by the key afterwards takes no shuffle of its own.
    """
    return table.read(version, parts).join(keys, table.keys, "left_semi")


def derived(spark: SparkSession, env: Environment) -> dict[str, Derived]:
    """The tables of the gold layer, each after those it is derived from."""
    customers, products, orders, items = (silver_table(spark, env, t) for t in ("customers", "products", "orders", "order_items"))
    by_order, by_product, by_customer = (sums_table(spark, env, of) for of in ("order", "product", "customer"))
    marts = {mart: mart_table(spark, env, mart) for mart in GOLD}
    measures = ["quantity", "value"]
    for table in (customers, products, orders, items, by_order, by_product, by_customer, *marts.values()):
        table.alone = True
    found: dict[tuple, DataFrame] = {}

    def of_items(target: KeyedTable, key: str) -> Derived:
        return Derived(
            target, {"order_items": items}, lambda tables: _kept(tables["order_items"], key),
            lambda changes, seen, now, mark: _add(target, _kept(changes["order_items"], key), "n_items", mark),
        )

    def joined(key: str, rows: KeyedTable, sums: KeyedTable, names: tuple[str, str], count: str, target: KeyedTable, nulls: bool = True) -> Derived:
        """Rows with their sums, summed by the key of the target; ``nulls`` if a NULL is a group of its own."""
        [by] = target.keys

        def grouped(some: DataFrame) -> DataFrame:
            return regrouped(some if nulls else some.filter(F.col(by).isNotNull()), [by], count, measures)

        def whole(tables: Tables) -> DataFrame:
            return grouped(tables[names[0]].join(tables[names[1]], key))

        def follow(changes: Tables, seen: Versions, now: Versions, mark: str) -> int:
            at = (key, *seen.values(), *now.values())
            if at not in found:  # two tables may follow the same changes
                touched = materialize(every(list(changes.values()), key), "touched")
                parts = rows.parts_of(touched)  # of both tables: they are dealt by the same key
                before, after = (_rows_of(touched, parts, rows, v[names[0]]).join(_rows_of(touched, parts, sums, v[names[1]]), key) for v in (seen, now))
                columns = [*NOTED[names[0]], *[c for m in measures for c in (f"{m}_values", m)]]
                found[at] = materialize(signed(before.select(*columns), after.select(*columns)), "signed")
            return _add(target, grouped(found[at]), count, mark)

        return Derived(target, {names[0]: rows, names[1]: sums}, whole, follow)

    def named(key: str, rows: KeyedTable, sums: KeyedTable, names: tuple[str, str], shown: list[Column], target: KeyedTable) -> Derived:
        """Sums with the names that belong to their keys."""

        def follow(changes: Tables, seen: Versions, now: Versions, mark: str) -> int:
            touched = materialize(every(list(changes.values()), key), "touched")
            parts = target.parts_of(touched)
            fresh = _rows_of(touched, parts, rows, now[names[0]]).join(_rows_of(touched, parts, sums, now[names[1]]), key).select(*shown)
            return target.replace(touched, materialize(fresh, "named"), mark, parts)

        return Derived(target, {names[0]: rows, names[1]: sums}, lambda t: t[names[0]].join(t[names[1]], key).select(*shown), follow)

    per_customer = ["customer_id", "full_name", F.col("n_orders").alias("total_orders"), value_of("value", "double").alias("lifetime_value")]
    per_product = ["product_id", "product_name", value_of("quantity", "long").alias("total_quantity"), value_of("value", "double").alias("total_revenue")]
    both = ("orders", "order_sums")
    return {
        "order_sums": of_items(by_order, "order_id"),
        "product_sums": of_items(by_product, "product_id"),
        "daily_sales": joined("order_id", orders, by_order, both, "n_orders", marts["daily_sales"]),
        "customer_sums": joined("order_id", orders, by_order, both, "n_orders", by_customer, nulls=False),
        "customer_lifetime_value": named("customer_id", customers, by_customer, ("customers", "customer_sums"), per_customer, marts["customer_lifetime_value"]),
        "top_products": named("product_id", products, by_product, ("products", "product_sums"), per_product, marts["top_products"]),
        "category_sales": joined("product_id", products, by_product, ("products", "product_sums"), "n_products", marts["category_sales"]),
    }


def refresh_gold(spark: SparkSession, env: Environment, full: bool = False) -> dict[str, int | None]:
    """Bring every mart up to the silver tables; new versions, None where nothing was to do.

    A mart follows what changed; a key that has no row any more loses its row, and a NULL day or category is a key like any
    other, so the result is always that of a rebuild.
    """
    done = {name: table.bring_up(full) for name, table in derived(spark, env).items()}
    return {mart: done[mart] for mart in GOLD}


def _dated(items: DataFrame, orders: DataFrame) -> DataFrame:
    """Items with the day of their order, NULL if there is none."""
    return items.select(*NOTED["order_items"]).join(orders.select("order_id", "order_date"), "order_id", "left").select(*NOTED["order_items"], "order_date")


def refresh_items_by_day(spark: SparkSession, env: Environment, full: bool = False) -> int | None:
    """Bring the items by day up to the silver tables.

    Items that came, went or changed, and those of orders that moved to another day, are taken from the days that they were
    in and put into those they belong to.  Days that only gain items get a folder more, days that lose some are written anew,
    and no other day is read.  An order that comes after its items takes them from the part without a day.
    """
    orders, items, target = silver_table(spark, env, "orders"), silver_table(spark, env, "order_items"), items_by_day(spark, env)

    def follow(changes: Tables, seen: Versions, now: Versions, mark: str) -> int:
        touched = materialize(every([changes["orders"], changes["order_items"]], "order_id"), "touched")
        columns = NOTED["order_items"]
        parts = orders.parts_of(touched)
        before, after = (_rows_of(touched, parts, orders, v["orders"]).select("order_id", "order_date") for v in (seen, now))
        days = touched.join(before, "order_id", "left")
        old = matching(target.read(of=target.parts_of(days)), touched, "left_semi")
        # Items without an order cannot be touched by one: only their own changes count.
        loose = changes["order_items"].filter(F.col("order_id").isNull()).withColumn("order_date", F.lit(None).cast("date"))
        gone = old.select(F.lit(1).cast("long").alias("sign"), *columns)
        moved = net(gone.unionByName(changes["order_items"].filter(F.col("order_id").isNotNull())))
        come = moved.join(after, "order_id", "left").select(*columns, "order_date")
        change = materialize(net(signed(old, come).unionByName(loose.select("sign", *columns, "order_date"))), "moved")
        less, more = change.filter("sign < 0"), change.filter("sign > 0").drop("sign")
        anew = target.parts_of(less)
        kept = matching(target.read(of=anew), less.select("order_item_id", "order_date"), "left_anti")
        return target.rewrite(anew, kept.unionByName(more), change, mark, target.parts_of(more))

    table = Derived(target, {"orders": orders, "order_items": items}, lambda t: _dated(t["order_items"], t["orders"]), follow)
    return table.bring_up(full)


def _new_bytes(spark: SparkSession, env: Environment, full: bool) -> int:
    """The size of the bronze files that silver has not seen; contents are not read."""
    total = 0
    for table in CLEANERS:
        commit = None if full else silver_table(spark, env, table).latest()
        _bronze(spark, env, table)
        files = spark.read.format("binaryFile").option("pathGlobFilter", "*.parquet").load(env.table_path("bronze", table))
        if INGEST_BATCH in files.columns:
            new = files if commit is None else files.filter(F.col(INGEST_BATCH) > int(commit["mark"]))
            total += new.agg(F.sum("_metadata.file_size").alias("bytes")).first()["bytes"] or 0
    return total


def refresh(
    spark: SparkSession, env: Environment, at: Column | None = None, full: bool = False
) -> dict[str, dict[str, int | None]]:
    """Landing to gold.  ``at`` fixes the audit timestamp.  Shuffles are sized from what is new in bronze."""
    bronze = load_bronze(spark, env, at)
    with sized_shuffles(spark, _new_bytes(spark, env, full)):
        return {
            "bronze": bronze,
            "silver": refresh_silver(spark, env, at, full),
            "gold": refresh_gold(spark, env, full),
        }
