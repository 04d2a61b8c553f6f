"""Bronze to silver: rename, clean, cast, filter, one row per key, declared schema."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from oremill.functions import clean_text, guarded_double, guarded_int, parse_date
from oremill.operators.dedup import latest_per_key
from oremill.operators.project import align_to_schema, rename_columns, stamp
from oremill.schemas import KEYS, SILVER

# Raw column name to table column name.
RENAMES = {
    "customers": {
        "CustomerID": "customer_id", "FullName": "full_name", "Email": "email", "SignUpDate": "signup_date",
        "City": "city", "Country": "country",
    },
    "products": {
        "ProductID": "product_id", "ProductName": "product_name", "Category": "category", "Brand": "brand",
        "Price": "price",
    },
    "orders": {
        "OrderID": "order_id", "CustomerID": "customer_id", "OrderDate": "order_date", "OrderStatus": "order_status",
    },
    "order_items": {
        "OrderItemID": "order_item_id", "OrderID": "order_id", "ProductID": "product_id", "Quantity": "quantity",
        "PricePerUnit": "price_per_unit",
    },
}
CANCELLED = "CANCELLED"


NEWEST = ("ingest_ts",)


def _newest(named: DataFrame, table: str, newest: tuple[str, ...]) -> DataFrame:
    """One raw row per key, the last by ``newest``.  Casts and patterns come after it: only survivors are cleaned."""
    return latest_per_key(named, [KEYS[table]], list(newest))


def _finish(cleaned: DataFrame, table: str, at: Column | None) -> DataFrame:
    return align_to_schema(stamp(cleaned, "updated_ts", at), SILVER[table])


def silver_customers(bronze: DataFrame, at: Column | None = None, newest: tuple[str, ...] = NEWEST) -> DataFrame:
    """The latest record of each customer; sign-up dates that are not dates become NULL."""
    rows = _newest(rename_columns(bronze, RENAMES["customers"]), "customers", newest)
    return _finish(rows.withColumn("signup_date", parse_date("signup_date")), "customers", at)


def silver_products(bronze: DataFrame, at: Column | None = None, newest: tuple[str, ...] = NEWEST) -> DataFrame:
    """One row per product; categories upper-cased, malformed prices NULL."""
    rows = _newest(rename_columns(bronze, RENAMES["products"]), "products", newest)
    cleaned = rows.withColumns(
        {"category": clean_text("category"), "brand": F.trim("brand"), "price": guarded_double("price")}
    )
    return _finish(cleaned, "products", at)


def silver_orders(
    bronze: DataFrame,
    at: Column | None = None,
    newest: tuple[str, ...] = NEWEST,
    keep_null_status: bool = False,
) -> DataFrame:
    """One row per order that was not cancelled; cancelled records are dropped before the latest is chosen.

    An order without a status is dropped as well, as a comparison with NULL is not true; ``keep_null_status`` keeps
    it.
    """
    named = rename_columns(bronze, RENAMES["orders"]).withColumn("order_status", clean_text("order_status"))
    wanted = F.col("order_status") != CANCELLED
    if keep_null_status:
        wanted = wanted | F.col("order_status").isNull()
    rows = _newest(named.filter(wanted), "orders", newest)
    return _finish(rows.withColumn("order_date", parse_date("order_date")), "orders", at)


def silver_order_items(bronze: DataFrame, at: Column | None = None, newest: tuple[str, ...] = NEWEST) -> DataFrame:
    """One row per order item; quantities and prices that are not well-formed become NULL."""
    rows = _newest(rename_columns(bronze, RENAMES["order_items"]), "order_items", newest)
    cleaned = rows.withColumns(
        {"quantity": guarded_int("quantity"), "price_per_unit": guarded_double("price_per_unit")}
    )
    return _finish(cleaned, "order_items", at)


CLEANERS = {
    "customers": silver_customers,
    "products": silver_products,
    "orders": silver_orders,
    "order_items": silver_order_items,
}
