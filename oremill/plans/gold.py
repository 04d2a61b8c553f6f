"""Silver to gold: the marts.

Silver tables hold one row per key, and every mart is built on that.  Items are summed to one row per order (or
product) *before* they are joined: Spark adds them up inside each task first, so an order, product or NULL key that
holds a third of all items crosses the network as one row per task, every join is between unique keys, and an
order is counted by a plain count where a join of raw items would need COUNT(DISTINCT).  Marts built together can share
these sums: pass them as ``totals``, stored, and items are shuffled once for each key and not for each mart.

A NULL quantity or price makes the item's amount NULL, which a sum skips; a group of only such items sums to NULL and
its orders still count.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _amount() -> Column:
    return F.col("quantity") * F.col("price_per_unit")


def order_totals(items: DataFrame) -> DataFrame:
    """One row per order with at least one item."""
    return items.groupBy("order_id").agg(F.sum(_amount()).alias("order_value"))


def product_totals(items: DataFrame) -> DataFrame:
    """One row per product with at least one item."""
    return items.groupBy("product_id").agg(
        F.sum("quantity").alias("total_quantity"), F.sum(_amount()).alias("total_revenue")
    )


def since(orders: DataFrame, as_of: date | Column | None = None, days: int = 1) -> DataFrame:
    """Orders of the incremental window: the last ``days`` days up to ``as_of`` (default: today), and later."""
    day = F.current_date() if as_of is None else (as_of if isinstance(as_of, Column) else F.lit(as_of))
    return orders.filter(F.col("order_date") >= F.date_sub(day, days))


def sales_per_day(orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders and sales per day, from the sums per order."""
    return (
        orders.select("order_id", "order_date")
        .join(totals, "order_id")
        .groupBy("order_date")
        .agg(F.count("order_id").alias("total_orders"), F.sum("order_value").alias("total_sales"))
    )


def value_per_customer(customers: DataFrame, orders: DataFrame, totals: DataFrame) -> DataFrame:
    """Orders and value per customer with at least one order that has items, from the sums per order."""
    per_customer = (
        orders.select("order_id", "customer_id")
        .join(totals, "order_id")
        .groupBy("customer_id")
        .agg(F.count("order_id").alias("total_orders"), F.sum("order_value").alias("lifetime_value"))
    )
    return (
        customers.select("customer_id", "full_name")
        .join(per_customer, "customer_id")
        .select("customer_id", "full_name", "total_orders", "lifetime_value")
    )


def sales_per_product(products: DataFrame, totals: DataFrame) -> DataFrame:
    """Quantity and revenue of every product sold, from the sums per product."""
    return (
        products.select("product_id", "product_name")
        .join(totals, "product_id")
        .select("product_id", "product_name", "total_quantity", "total_revenue")
    )


def sales_per_category(products: DataFrame, totals: DataFrame) -> DataFrame:
    """Quantity and revenue per category, from the sums per product."""
    return (
        products.select("product_id", "category")
        .join(totals, "product_id")
        .groupBy("category")
        .agg(F.sum("total_quantity").alias("total_quantity"), F.sum("total_revenue").alias("total_revenue"))
    )


def daily_sales(orders: DataFrame, items: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Orders and sales per day.  For a refresh of the last days pass ``since(orders, ...)``."""
    return sales_per_day(orders, order_totals(items) if totals is None else totals)


def daily_sales_by_day(orders: DataFrame, items: DataFrame) -> DataFrame:
    """Orders and sales per day from items stored with the day of their order as partition.

    The day is part of the join, so only partitions of days that ``orders`` have are read: those that a filter on the day
    names, or, where another filter picks the orders, those that Spark finds when it runs.
    """
    totals = items.groupBy("order_id", "order_date").agg(F.sum(_amount()).alias("order_value"))
    both = orders.select("order_id", "order_date").join(totals, ["order_id", "order_date"])
    return both.groupBy("order_date").agg(F.count("order_id").alias("total_orders"), F.sum("order_value").alias("total_sales"))


def customer_lifetime_value(customers: DataFrame, orders: DataFrame, items: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Orders and value per customer."""
    return value_per_customer(customers, orders, order_totals(items) if totals is None else totals)


def top_products(products: DataFrame, items: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Quantity and revenue of every product sold."""
    return sales_per_product(products, product_totals(items) if totals is None else totals)


def category_sales(products: DataFrame, items: DataFrame, totals: DataFrame | None = None) -> DataFrame:
    """Quantity and revenue per category."""
    return sales_per_category(products, product_totals(items) if totals is None else totals)


def top_products_report(mart: DataFrame, count: int) -> DataFrame:
    """The ``count`` products of the highest revenue; ties go to the smaller id."""
    return mart.orderBy(F.col("total_revenue").desc_nulls_last(), "product_id").limit(count)


def lifetime_value_of_changed(
    customers: DataFrame, orders: DataFrame, items: DataFrame, changed_orders: DataFrame
) -> DataFrame:
    """The lifetime value of only those customers that have an order among ``changed_orders``, over all their orders.

    Items are cut down to those customers' orders before they are summed.
    """
    touched = changed_orders.select("customer_id").distinct()
    theirs = orders.join(touched, "customer_id", "left_semi")
    return customer_lifetime_value(
        customers.join(touched, "customer_id", "left_semi"),
        theirs,
        items.join(theirs.select("order_id"), "order_id", "left_semi"),
    )
