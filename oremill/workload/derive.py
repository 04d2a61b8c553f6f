"""Raw (bronze) rows, task logs and file listings, derived by Spark from the given tables.

Every row of the given table is used.  The expressions add the faults the cleaning has to handle: repeated records,
text in number columns, overflowing and malformed numbers, bad dates, stray blanks and NULLs.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The fixed "today" of incremental queries; the given orders end on this day.
AS_OF = date(2001, 8, 1)
STAMP = "2024-02-01 00:00:00"
ORDERS_PER_FEED = 5000


def stamp() -> Column:
    return F.lit(STAMP).cast("timestamp")


# Declared like every other table, so that reading one starts no job to infer its schema.
GIVEN = {
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, c_mktsegment STRING",
    "part": "p_partkey BIGINT, p_name STRING, p_brand STRING, p_type STRING, p_size INT, p_retailprice DOUBLE",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
    "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "lineitem": "l_orderkey BIGINT, l_partkey BIGINT, l_suppkey BIGINT, l_linenumber INT, l_quantity DOUBLE, "
    "l_extendedprice DOUBLE, l_discount DOUBLE, l_tax DOUBLE, l_returnflag STRING, l_linestatus STRING, "
    "l_shipdate TIMESTAMP_NTZ",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, value DOUBLE, props STRING",
}


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(GIVEN[name]).parquet(f"{sf_dir}/{name}.parquet")


def _repeated(df: DataFrame, key: str, every: int) -> DataFrame:
    """Every row once, and rows whose key is a multiple of ``every`` a second time; ``gen`` numbers the copies."""
    return df.selectExpr("*", f"explode(IF({key} % {every} = 0, array(1, 2), array(1))) AS gen")


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = _table(spark, sf_dir, "nation").selectExpr("n_nationkey AS c_nationkey", "n_name")
    rows = _repeated(_table(spark, sf_dir, "customer").join(nation, "c_nationkey"), "c_custkey", 10)
    return rows.selectExpr(
        "concat('CUST-', c_custkey) AS CustomerID",
        "concat(' ', c_name) AS FullName",
        "concat(lower(c_name), '@example.com') AS Email",
        "IF(c_custkey % 13 = 0, 'not-a-date', concat('20', 10 + c_custkey % 10, '-0', 1 + c_custkey % 9, '-15'))"
        " AS SignUpDate",
        "IF(gen = 2, 'MOVED', c_mktsegment) AS City",
        "n_name AS Country",
        "TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(gen) AS ingest_ts",
    )


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _table(spark, sf_dir, "part").selectExpr(
        "concat('PROD-', p_partkey) AS ProductID",
        "p_name AS ProductName",
        "IF(p_partkey % 2 = 0, concat('  ', lower(p_type), ' '), p_type) AS Category",
        "concat(' ', p_brand, ' ') AS Brand",
        """CASE WHEN p_partkey % 17 = 0 THEN 'N/A'
                WHEN p_partkey % 19 = 0 THEN ''
                WHEN p_partkey % 23 = 0 THEN concat('-', CAST(p_retailprice AS DECIMAL(18,2)))
                WHEN p_partkey % 29 = 0 THEN NULL
                ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS STRING) END AS Price""",
        "TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts",
    )


def orders_with_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with the number they were made from."""
    return _repeated(_table(spark, sf_dir, "orders"), "o_orderkey", 20).selectExpr(
        "o_orderkey",
        "concat('ORD-', o_orderkey) AS OrderID",
        "concat('CUST-', o_custkey) AS CustomerID",
        "CAST(CAST(o_orderdate AS DATE) AS STRING) AS OrderDate",
        """CASE WHEN o_orderkey % 50 = 0 THEN NULL
                WHEN o_orderstatus = 'P' THEN ' cancelled '
                WHEN o_orderstatus = 'F' THEN 'Completed'
                ELSE 'pending' END AS OrderStatus""",
        "TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts",
    )


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return orders_with_key(spark, sf_dir).drop("o_orderkey")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _repeated(_table(spark, sf_dir, "lineitem"), "l_orderkey", 20).selectExpr(
        "concat('ITEM-', l_orderkey, '-', l_linenumber, '-', l_partkey, '-', l_suppkey) AS OrderItemID",
        "concat('ORD-', l_orderkey) AS OrderID",
        "concat('PROD-', l_partkey) AS ProductID",
        """CASE WHEN l_partkey % 31 = 0 THEN 'two'
                WHEN l_partkey % 37 = 0 THEN '99999999999'
                ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS Quantity""",
        "IF(l_suppkey % 41 = 0, '1.2.3', CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS STRING)) AS PricePerUnit",
        "TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts",
    )


BRONZE = {"customers": customers, "products": products, "orders": orders, "order_items": order_items}


def task_control(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One log row per event."""
    return _table(spark, sf_dir, "events").selectExpr(
        "event_type AS job_name",
        "concat('J-', event_type) AS job_id",
        "concat('R', event_id div 100) AS parent_run_id",
        "concat('T', user_id % 20) AS task_name",
        "CAST(event_id AS STRING) AS task_run_id",
        "CAST(NULL AS TIMESTAMP) AS filter_start_ts",
        "CAST(ts AS TIMESTAMP) AS filter_end_ts",
        "CAST(ts AS TIMESTAMP) AS execution_start_ts",
        "CAST(ts AS TIMESTAMP) + make_dt_interval(0, 0, 0, event_id % 7200) AS execution_end_ts",
        "event_id % 1000 AS source_count",
        "event_id % 1000 - IF(event_id % 11 = 0, 1, 0) AS target_count",
        """CASE event_id % 7 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'INITIATED' WHEN 2 THEN 'NOT STARTED'
                             ELSE 'COMPLETED' END AS status""",
        "concat(event_type, '_', date_format(ts, 'yyyyMMdd'), '.csv') AS last_processed_file",
    )


def task_metadata(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One metadata row per event, so tasks repeat; some tasks are inactive, some flags need trimming."""
    return _table(spark, sf_dir, "events").selectExpr(
        "'retail' AS application",
        "event_type AS job_name",
        "concat('T', user_id % 20) AS task_name",
        "concat('G', user_id % 20 % 3) AS grouping_id",
        "CASE user_id % 20 % 7 WHEN 0 THEN 'N' WHEN 1 THEN ' y ' ELSE 'Y' END AS is_active",
    )


def file_listing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One file arrival per event, in a monthly or daily folder of its job; some names carry no timestamp."""
    named = _table(spark, sf_dir, "events").selectExpr(
        "*",
        """IF(event_id % 10 = 0, concat('plain', event_id, '.csv'),
              concat(event_type, '_', date_format(ts, 'yyyyMMddHHmmss'), '.csv')) AS name""",
    )
    return named.selectExpr(
        "concat_ws('/', '/data/landing', event_type, IF(event_id % 3 = 0, 'monthly', 'daily'), name) AS path",
        "name",
        "event_id AS size",
        "CAST(ts AS TIMESTAMP) AS modified",
        "event_type AS job_name",
        "concat('T', user_id % 20) AS task_name",
    )
