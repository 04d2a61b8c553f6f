"""Declared tables, one ``StructType`` each.

Column names, order and types are fixed values of the data model.  Gold totals and the counts of the control log are
BIGINT, since ``COUNT`` and ``SUM`` give BIGINT and narrowing them would overflow on large groups.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import types as T

TYPES = {
    "STRING": T.StringType(),
    "INT": T.IntegerType(),
    "BIGINT": T.LongType(),
    "DOUBLE": T.DoubleType(),
    "DATE": T.DateType(),
    "TIMESTAMP": T.TimestampType(),
    "DECIMAL": T.DecimalType(38, 0),
}


def declared(columns: str) -> T.StructType:
    """A schema from ``"name TYPE, name TYPE"``; needs no running session, so tables can be module constants."""
    pairs = (column.split() for column in columns.split(", "))
    return T.StructType([T.StructField(name, TYPES[kind]) for name, kind in pairs])


# Raw payload stays text: malformed values must survive the load.
BRONZE = {
    "customers": declared(
        "CustomerID STRING, FullName STRING, Email STRING, SignUpDate STRING, City STRING, Country STRING, "
        "ingest_ts TIMESTAMP"
    ),
    "products": declared(
        "ProductID STRING, ProductName STRING, Category STRING, Brand STRING, Price STRING, ingest_ts TIMESTAMP"
    ),
    "orders": declared(
        "OrderID STRING, CustomerID STRING, OrderDate STRING, OrderStatus STRING, ingest_ts TIMESTAMP"
    ),
    "order_items": declared(
        "OrderItemID STRING, OrderID STRING, ProductID STRING, Quantity STRING, PricePerUnit STRING, "
        "ingest_ts TIMESTAMP"
    ),
}

SILVER = {
    "customers": declared(
        "customer_id STRING, full_name STRING, email STRING, signup_date DATE, city STRING, country STRING, "
        "updated_ts TIMESTAMP"
    ),
    "products": declared(
        "product_id STRING, product_name STRING, category STRING, brand STRING, price DOUBLE, updated_ts TIMESTAMP"
    ),
    "orders": declared(
        "order_id STRING, customer_id STRING, order_date DATE, order_status STRING, updated_ts TIMESTAMP"
    ),
    "order_items": declared(
        "order_item_id STRING, order_id STRING, product_id STRING, quantity INT, price_per_unit DOUBLE, "
        "updated_ts TIMESTAMP"
    ),
}

GOLD = {
    "daily_sales": declared("order_date DATE, total_orders BIGINT, total_sales DOUBLE"),
    "customer_lifetime_value": declared(
        "customer_id STRING, full_name STRING, total_orders BIGINT, lifetime_value DOUBLE"
    ),
    "top_products": declared(
        "product_id STRING, product_name STRING, total_quantity BIGINT, total_revenue DOUBLE"
    ),
    "category_sales": declared("category STRING, total_quantity BIGINT, total_revenue DOUBLE"),
}

CONTROL = {
    "task_control": declared(
        "job_name STRING, job_id STRING, parent_run_id STRING, task_name STRING, task_run_id STRING, "
        "filter_start_ts TIMESTAMP, filter_end_ts TIMESTAMP, execution_start_ts TIMESTAMP, "
        "execution_end_ts TIMESTAMP, source_count BIGINT, target_count BIGINT, status STRING, last_processed_file STRING"
    ),
    "task_run_log": declared(
        "job_id STRING, parent_run_id STRING, task_run_id STRING, procedure_name STRING, create_dt TIMESTAMP, "
        "message_type STRING, priority DECIMAL, message_cd STRING, primary_message STRING, "
        "secondary_message STRING, login_id STRING, data_key STRING, records_in DECIMAL, "
        "records_out DECIMAL, procedure_runtime_stamp STRING, records_updated DECIMAL"
    ),
    "ingest_metadata": declared(
        "application STRING, job_name STRING, task_name STRING, grouping_id STRING, transformation_type STRING, "
        "execute_child_notebook STRING, load_type STRING, source_adls_path STRING, source_file_extension STRING, "
        "source_file_header STRING, source_file_delimiter STRING, source_file_escape_quote STRING, "
        "source_schema STRING, source_table STRING, target_notebook STRING, target_notebook_parameters STRING, "
        "target_schema STRING, target_table STRING, merge_cols STRING, load_query STRING, "
        "archival_adls_path STRING, is_active STRING, created_user_id STRING, created_timestamp STRING, "
        "last_updated_user_id STRING, last_updated_timestamp STRING, ingest_all_files_from_adls STRING, "
        "ingest_latest_files_from_adls STRING, ingest_oldest_files_from_adls STRING, "
        "run_only_if_prev_job_success STRING, skip_rows INT, file_encoding STRING"
    ),
}

LAYERS = {"bronze": BRONZE, "silver": SILVER, "gold": GOLD, "control": CONTROL}

# Primary key of each entity, and the key each mart is upserted on.
KEYS = {
    "customers": "customer_id",
    "products": "product_id",
    "orders": "order_id",
    "order_items": "order_item_id",
    "daily_sales": "order_date",
    "customer_lifetime_value": "customer_id",
    "top_products": "product_id",
    "category_sales": "category",
}


def payload(schema: T.StructType) -> T.StructType:
    """The columns a raw file carries: the declared ones without ``ingest_ts``."""
    return T.StructType([f for f in schema.fields if f.name != "ingest_ts"])


def declare_layer(spark: SparkSession, layer: str, prefix: str = "", location: str | None = None) -> list[str]:
    """Create the database (under ``location``, if given) and empty tables of one layer; returns the table names."""
    database = f"{prefix}{layer}"
    place = f" LOCATION '{location}'" if location else ""
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {database}{place}")
    names = []
    for table, schema in LAYERS[layer].items():
        name = f"{database}.{table}"
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({schema.toDDL()}) USING parquet")
        names.append(name)
    return names


def truncate_layer(spark: SparkSession, layer: str, prefix: str = "") -> list[str]:
    """Empty every table of one layer, keeping the declarations."""
    names = [f"{prefix}{layer}.{table}" for table in LAYERS[layer]]
    for name in names:
        spark.sql(f"TRUNCATE TABLE {name}")
    return names
