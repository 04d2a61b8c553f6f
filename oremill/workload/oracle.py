"""The SQL each registered query is compared with, for DuckDB over the same tables.

Written apart from the Spark code, from the same definitions: joins come before the sums here, distinct orders are
counted as such, upserts are full joins.
"""

from __future__ import annotations

STAMP = "2024-02-01 00:00:00.000000"
ISO = "'%Y-%m-%d %H:%M:%S.%f'"

# Raw rows, cleaned tables, marts, logs and listings as common table expressions.
TABLES = f"""
raw_customers AS (
  SELECT 'CUST-' || c_custkey AS CustomerID, ' ' || c_name AS FullName, lower(c_name) || '@example.com' AS Email,
         CASE WHEN c_custkey % 13 = 0 THEN 'not-a-date'
              ELSE '20' || (10 + c_custkey % 10) || '-0' || (1 + c_custkey % 9) || '-15' END AS SignUpDate,
         CASE WHEN gen = 2 THEN 'MOVED' ELSE c_mktsegment END AS City, n_name AS Country,
         TIMESTAMP '2024-01-01 00:00:00' + to_days(CAST(gen AS INTEGER)) AS ingest_ts
  FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN (VALUES (1), (2)) g(gen)
    ON gen = 1 OR c_custkey % 10 = 0),
raw_products AS (
  SELECT 'PROD-' || p_partkey AS ProductID, p_name AS ProductName,
         CASE WHEN p_partkey % 2 = 0 THEN '  ' || lower(p_type) || ' ' ELSE p_type END AS Category,
         ' ' || p_brand || ' ' AS Brand,
         CASE WHEN p_partkey % 17 = 0 THEN 'N/A' WHEN p_partkey % 19 = 0 THEN ''
              WHEN p_partkey % 23 = 0 THEN '-' || CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR)
              WHEN p_partkey % 29 = 0 THEN NULL
              ELSE CAST(CAST(p_retailprice AS DECIMAL(18,2)) AS VARCHAR) END AS Price,
         TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts
  FROM part),
raw_orders AS (
  SELECT o_orderkey, 'ORD-' || o_orderkey AS OrderID, 'CUST-' || o_custkey AS CustomerID,
         CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS OrderDate,
         CASE WHEN o_orderkey % 50 = 0 THEN NULL WHEN o_orderstatus = 'P' THEN ' cancelled '
              WHEN o_orderstatus = 'F' THEN 'Completed' ELSE 'pending' END AS OrderStatus,
         TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts
  FROM orders JOIN (VALUES (1), (2)) g(gen) ON gen = 1 OR o_orderkey % 20 = 0),
raw_items AS (
  SELECT 'ITEM-' || l_orderkey || '-' || l_linenumber || '-' || l_partkey || '-' || l_suppkey AS OrderItemID,
         'ORD-' || l_orderkey AS OrderID, 'PROD-' || l_partkey AS ProductID,
         CASE WHEN l_partkey % 31 = 0 THEN 'two' WHEN l_partkey % 37 = 0 THEN '99999999999'
              ELSE CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) END AS Quantity,
         CASE WHEN l_suppkey % 41 = 0 THEN '1.2.3'
              ELSE CAST(CAST(l_extendedprice AS DECIMAL(18,2)) AS VARCHAR) END AS PricePerUnit,
         TIMESTAMP '2024-01-02 00:00:00' AS ingest_ts
  FROM lineitem JOIN (VALUES (1), (2)) g(gen) ON gen = 1 OR l_orderkey % 20 = 0),
s_customers AS (
  SELECT CustomerID AS customer_id, FullName AS full_name, Email AS email,
         TRY_CAST(SignUpDate AS DATE) AS signup_date, City AS city, Country AS country
  FROM raw_customers
  QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY ingest_ts DESC NULLS LAST, City DESC NULLS LAST) = 1),
s_products AS (
  SELECT ProductID AS product_id, ProductName AS product_name, upper(trim(Category)) AS category,
         trim(Brand) AS brand,
         CASE WHEN regexp_matches(Price, '^[0-9]+([.][0-9]+)?$') THEN TRY_CAST(Price AS DOUBLE) END AS price
  FROM raw_products),
any_orders AS (
  SELECT DISTINCT OrderID AS order_id, CustomerID AS customer_id, TRY_CAST(OrderDate AS DATE) AS order_date,
         upper(trim(OrderStatus)) AS order_status
  FROM raw_orders),
s_orders AS (SELECT * FROM any_orders WHERE order_status <> 'CANCELLED'),
s_items AS (
  SELECT OrderItemID AS order_item_id, OrderID AS order_id, ProductID AS product_id,
         CASE WHEN regexp_matches(Quantity, '^[0-9]+$') THEN TRY_CAST(Quantity AS INTEGER) END AS quantity,
         CASE WHEN regexp_matches(PricePerUnit, '^[0-9]+([.][0-9]+)?$') THEN TRY_CAST(PricePerUnit AS DOUBLE) END
           AS price_per_unit
  FROM raw_items
  QUALIFY row_number() OVER (PARTITION BY OrderItemID
                             ORDER BY ingest_ts DESC, Quantity DESC NULLS LAST, PricePerUnit DESC NULLS LAST) = 1),
m_daily AS (
  SELECT o.order_date, count(DISTINCT o.order_id) AS total_orders,
         round(sum(i.quantity * i.price_per_unit), 2) AS total_sales
  FROM s_orders o JOIN s_items i ON o.order_id = i.order_id GROUP BY o.order_date),
m_daily_incr AS (SELECT * FROM m_daily WHERE order_date >= DATE '2001-07-25'),
m_ltv AS (
  SELECT c.customer_id, c.full_name, count(DISTINCT o.order_id) AS total_orders,
         round(sum(i.quantity * i.price_per_unit), 2) AS lifetime_value
  FROM s_customers c JOIN s_orders o ON c.customer_id = o.customer_id JOIN s_items i ON o.order_id = i.order_id
  GROUP BY c.customer_id, c.full_name),
m_products AS (
  SELECT p.product_id, p.product_name, CAST(sum(i.quantity) AS BIGINT) AS total_quantity,
         round(sum(i.quantity * i.price_per_unit), 2) AS total_revenue
  FROM s_products p JOIN s_items i ON p.product_id = i.product_id GROUP BY p.product_id, p.product_name),
m_categories AS (
  SELECT p.category, CAST(sum(i.quantity) AS BIGINT) AS total_quantity,
         round(sum(i.quantity * i.price_per_unit), 2) AS total_revenue
  FROM s_products p JOIN s_items i ON p.product_id = i.product_id GROUP BY p.category),
old_daily AS (
  SELECT order_date, CAST(0 AS BIGINT) AS total_orders, CAST(0 AS DOUBLE) AS total_sales
  FROM m_daily WHERE order_date < DATE '2001-07-29'),
old_products AS (
  SELECT product_id, product_name, CAST(0 AS BIGINT) AS total_quantity, CAST(0 AS DOUBLE) AS total_revenue
  FROM s_products WHERE price IS NOT NULL
  UNION ALL SELECT 'OLD-' || product_id, product_name, 0, 0 FROM s_products),
new_products AS (
  SELECT coalesce(s.product_id, t.product_id) AS product_id, 
         CASE WHEN s.product_id IS NULL THEN t.product_name ELSE s.product_name END AS product_name,
         CASE WHEN s.product_id IS NULL THEN t.total_quantity ELSE s.total_quantity END AS total_quantity,
         CASE WHEN s.product_id IS NULL THEN t.total_revenue ELSE s.total_revenue END AS total_revenue
  FROM old_products t FULL JOIN m_products s ON t.product_id = s.product_id),
old_ltv AS (
  SELECT customer_id, '?' AS full_name, CAST(0 AS BIGINT) AS total_orders, CAST(0 AS DOUBLE) AS lifetime_value
  FROM s_customers WHERE signup_date IS NOT NULL),
task_log AS (
  SELECT event_type AS job_name, 'J-' || event_type AS job_id, 'R' || (event_id // 100) AS parent_run_id,
         'T' || (user_id % 20) AS task_name, CAST(event_id AS VARCHAR) AS task_run_id, ts AS filter_end_ts,
         ts AS execution_start_ts, ts + to_seconds(event_id % 7200) AS execution_end_ts,
         event_id % 7200 AS seconds, CAST(event_id % 1000 AS BIGINT) AS source_count,
         CAST(event_id % 1000 - CASE WHEN event_id % 11 = 0 THEN 1 ELSE 0 END AS BIGINT) AS target_count,
         CASE event_id % 7 WHEN 0 THEN 'FAILED' WHEN 1 THEN 'INITIATED' WHEN 2 THEN 'NOT STARTED' ELSE 'COMPLETED' END
           AS status,
         event_type || '_' || strftime(ts, '%Y%m%d') || '.csv' AS last_processed_file
  FROM events),
task_meta AS (
  SELECT 'retail' AS application, event_type AS job_name, 'T' || (user_id % 20) AS task_name,
         'G' || (user_id % 20 % 3) AS grouping_id,
         CASE user_id % 20 % 7 WHEN 0 THEN 'N' WHEN 1 THEN ' y ' ELSE 'Y' END AS is_active
  FROM events),
active AS (SELECT DISTINCT * FROM task_meta WHERE upper(trim(is_active)) = 'Y'),
verdicts AS (
  SELECT *, CASE WHEN source_count <> target_count THEN 'FAILED' ELSE 'COMPLETED' END AS load_status,
         CASE WHEN source_count <> target_count
              THEN task_name || ' - FAILED source and target counts are not matching!'
              ELSE task_name || ' - COMPLETED' END AS load_message
  FROM task_log),
listing AS (
  SELECT '/data/landing/' || event_type || '/' || CASE WHEN event_id % 3 = 0 THEN 'monthly' ELSE 'daily' END || '/' ||
           CASE WHEN event_id % 10 = 0 THEN 'plain' || event_id || '.csv'
                ELSE event_type || '_' || strftime(ts, '%Y%m%d%H%M%S') || '.csv' END AS path,
         event_id AS size, ts AS modified, event_type AS job_name, 'T' || (user_id % 20) AS task_name
  FROM events)
"""


def _select(body: str) -> str:
    return f"WITH {TABLES} {body}"


def _stamped(table: str, columns: str = "*") -> str:
    return f"SELECT {columns}, '{STAMP}' AS updated_ts FROM {table}"


_ITEM_COLUMNS = "OrderItemID AS order_item_id, OrderID AS order_id, ProductID AS product_id, Quantity AS quantity"
_SILVER = {"customers": "s_customers", "products": "s_products", "orders": "s_orders", "order_items": "s_items"}
_RAW = {"customers": "raw_customers", "products": "raw_products", "orders": "raw_orders", "order_items": "raw_items"}
_GOLD = {"daily_sales": "m_daily", "customer_lifetime_value": "m_ltv", "top_products": "m_products", "category_sales": "m_categories"}
# Columns with a type other than text, and columns that the rows at hand leave NULL.
_CONFORMANCE = {
    "bronze customers": ("raw_customers", "CustomerID FullName Email SignUpDate City Country ingest_ts:timestamp", ""),
    "bronze products": ("raw_products", "ProductID ProductName Category Brand Price ingest_ts:timestamp", ""),
    "bronze orders": ("raw_orders", "OrderID CustomerID OrderDate OrderStatus ingest_ts:timestamp", ""),
    "bronze order_items": ("raw_items", "OrderItemID OrderID ProductID Quantity PricePerUnit ingest_ts:timestamp", ""),
    "silver customers": ("s_customers", "customer_id full_name email signup_date:date city country", ""),
    "silver products": ("s_products", "product_id product_name category brand price:double", ""),
    "silver orders": ("s_orders", "order_id customer_id order_date:date order_status", ""),
    "silver order_items": ("s_items", "order_item_id order_id product_id quantity:int price_per_unit:double", ""),
    "gold daily_sales": ("m_daily", "order_date:date total_orders:bigint total_sales:double", ""),
    "gold customer_lifetime_value": ("m_ltv", "customer_id full_name total_orders:bigint lifetime_value:double", ""),
    "gold top_products": ("m_products", "product_id product_name total_quantity:bigint total_revenue:double", ""),
    "gold category_sales": ("m_categories", "category total_quantity:bigint total_revenue:double", ""),
    "control task_control": (
        "task_log",
        "job_name job_id parent_run_id task_name task_run_id filter_end_ts:timestamp execution_start_ts:timestamp"
        " execution_end_ts:timestamp source_count:bigint target_count:bigint status last_processed_file",
        "filter_start_ts:timestamp",
    ),
    "control task_run_log": (
        "(SELECT job_id, parent_run_id, task_run_id, 1 AS create_dt, 1 AS primary_message, source_count AS records_in,"
        " target_count AS records_out FROM task_log)",
        "job_id parent_run_id task_run_id create_dt:timestamp primary_message records_in:decimal(38,0)"
        " records_out:decimal(38,0)",
        "procedure_name message_type priority:decimal(38,0) message_cd secondary_message login_id data_key"
        " procedure_runtime_stamp records_updated:decimal(38,0)",
    ),
    "control ingest_metadata": (
        "task_meta",
        "application job_name task_name grouping_id is_active",
        "transformation_type execute_child_notebook load_type source_adls_path source_file_extension source_file_header"
        " source_file_delimiter source_file_escape_quote source_schema source_table target_notebook"
        " target_notebook_parameters target_schema target_table merge_cols load_query archival_adls_path created_user_id"
        " created_timestamp last_updated_user_id last_updated_timestamp ingest_all_files_from_adls"
        " ingest_latest_files_from_adls ingest_oldest_files_from_adls run_only_if_prev_job_success skip_rows:int"
        " file_encoding",
    ),
}


def _conformance() -> str:
    rows = []
    for place, (source, filled, empty) in _CONFORMANCE.items():
        layer, table = place.split()
        columns = [(c, f"count({c.partition(':')[0]})") for c in filled.split()] + [(c, "count(NULL)") for c in empty.split()]
        columns += [("updated_ts:timestamp", "count(*)")] if layer == "silver" else []
        for column, count in columns:
            name, _, kind = column.partition(":")
            rows.append(
                f"SELECT '{layer}' AS layer, '{table}' AS table_name, '{name}' AS column_name,"
                f" '{kind or 'string'}' AS data_type, CAST({count} AS BIGINT) AS filled FROM {source}"
            )
    return " UNION ALL ".join(rows)


def _truncated() -> str:
    layers = {"bronze": _RAW, "silver": _SILVER, "gold": _GOLD}
    return " UNION ALL ".join(
        f"SELECT '{layer}' AS layer, '{t}' AS table_name, count(*) AS rows_before, CAST(0 AS BIGINT) AS rows_after FROM {name}"
        for layer, tables in layers.items()
        for t, name in tables.items()
    )


def _per_table(tables: dict[str, str], columns: str) -> str:
    return " UNION ALL ".join(f"SELECT '{t}' AS table_name, {columns} FROM {name}" for t, name in tables.items())


_PRODUCT_PAYLOAD = "ProductID, ProductName, Category, Brand, Price"
_CUSTOMER_PAYLOAD = "CustomerID, FullName, Email, SignUpDate, City, Country"
_ORDER_PAYLOAD = "OrderID, CustomerID, OrderDate, OrderStatus"
_FEED = "CAST(o_orderkey // 5000 AS INTEGER)"

_BODIES = {
    "silver_customers": _stamped("s_customers", "* REPLACE (CAST(signup_date AS VARCHAR) AS signup_date)"),
    "silver_products": _stamped("s_products"),
    "silver_orders": _stamped("s_orders", "* REPLACE (CAST(order_date AS VARCHAR) AS order_date)"),
    "silver_order_items": _stamped("s_items"),
    "gold_daily_sales": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM m_daily",
    "gold_daily_sales_incr": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM m_daily_incr",
    "gold_customer_ltv": "SELECT * FROM m_ltv",
    "gold_top_products": "SELECT * FROM m_products",
    "gold_top_products_k": "SELECT * FROM m_products ORDER BY total_revenue DESC NULLS LAST, product_id LIMIT 10",
    "gold_category_sales": "SELECT * FROM m_categories",
    "gold_ltv_affected_keys": """
        SELECT * FROM m_ltv
        WHERE customer_id IN (SELECT customer_id FROM s_orders WHERE order_date >= DATE '2001-07-25')""",
    "upsert_daily_sales": """
        SELECT CAST(coalesce(s.order_date, t.order_date) AS VARCHAR) AS order_date,
               CASE WHEN s.order_date IS NULL THEN t.total_orders ELSE s.total_orders END AS total_orders,
               CASE WHEN s.order_date IS NULL THEN t.total_sales ELSE s.total_sales END AS total_sales
        FROM old_daily t FULL JOIN m_daily_incr s ON t.order_date = s.order_date""",
    "upsert_daily_sales_partitions": """
        SELECT CAST(coalesce(s.order_date, t.order_date) AS VARCHAR) AS order_date,
               coalesce(s.total_orders, t.total_orders) AS total_orders,
               CASE WHEN s.order_date IS NULL THEN t.total_sales ELSE s.total_sales END AS total_sales
        FROM old_daily t FULL JOIN m_daily_incr s ON t.order_date = s.order_date""",
    "upsert_daily_sales_window": """
        SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM (
          SELECT * FROM old_daily WHERE order_date < DATE '2001-07-25' UNION ALL SELECT * FROM m_daily_incr)""",
    "upsert_customer_ltv": """
        SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
               CASE WHEN s.customer_id IS NULL THEN t.full_name ELSE s.full_name END AS full_name,
               CASE WHEN s.customer_id IS NULL THEN t.total_orders ELSE s.total_orders END AS total_orders,
               CASE WHEN s.customer_id IS NULL THEN t.lifetime_value ELSE s.lifetime_value END AS lifetime_value
        FROM old_ltv t FULL JOIN m_ltv s ON t.customer_id = s.customer_id""",
    "file_times": f"""
        SELECT size, FILE_TS, strftime(coalesce(try_strptime(CASE WHEN length(FILE_TS) = 14 THEN FILE_TS END, '%Y%m%d%H%M%S'),
                                                try_strptime(CASE WHEN length(FILE_TS) = 8 THEN FILE_TS END, '%Y%m%d')), {ISO}) AS file_time
        FROM (SELECT size, CASE WHEN size % 10 = 0 THEN NULL ELSE CASE WHEN size % 3 = 0 THEN strftime(modified, '%Y%m%d') ELSE strftime(modified, '%Y%m%d%H%M%S') END END AS FILE_TS
              FROM listing)""",
    "file_runs": """
        SELECT l.size, l.job_name, l.task_name, r.task_run_id, coalesce(r.execution_end_ts >= l.modified, false) AS in_run
        FROM listing l ASOF LEFT JOIN (
          SELECT * FROM task_log WHERE CAST(task_run_id AS BIGINT) % 3 = 0
          QUALIFY row_number() OVER (PARTITION BY job_name, task_name, execution_start_ts ORDER BY task_run_id DESC) = 1) r
          ON l.job_name = r.job_name AND l.task_name = r.task_name AND l.modified >= r.execution_start_ts""",
    "distinct_customers_by_month": """
        SELECT strftime(order_date, '%Y-%m') AS span, count(DISTINCT customer_id) AS customers FROM s_orders GROUP BY 1
        UNION ALL SELECT 'all', count(DISTINCT customer_id) FROM s_orders""",
    "upsert_top_products": "SELECT * FROM new_products",
    "upsert_top_products_parts": "SELECT * FROM new_products",
    "upsert_customer_ltv_parts": """
        SELECT coalesce(s.customer_id, t.customer_id) AS customer_id,
               CASE WHEN s.customer_id IS NULL THEN t.full_name ELSE s.full_name END AS full_name,
               CASE WHEN s.customer_id IS NULL THEN t.total_orders ELSE s.total_orders END AS total_orders,
               CASE WHEN s.customer_id IS NULL THEN t.lifetime_value ELSE s.lifetime_value END AS lifetime_value
        FROM old_ltv t FULL JOIN m_ltv s ON t.customer_id = s.customer_id""",
    "table_changes": """
        SELECT CAST(-1 AS BIGINT) AS sign, t.* FROM old_products t JOIN m_products s ON t.product_id = s.product_id
        UNION ALL SELECT CAST(1 AS BIGINT), * FROM m_products""",
    "follow_changes": """
        SELECT product_id, count(*) AS n_items, CAST(sum(quantity) AS BIGINT) AS total_quantity,
               round(sum(quantity * price_per_unit), 2) AS total_revenue
        FROM s_items WHERE order_item_id NOT LIKE '%3' GROUP BY product_id""",
    "gold_daily_sales_by_day": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM m_daily_incr",
    "ingest_rejects": """
        SELECT OrderID, CustomerID, OrderDate, nullif(OrderStatus, '') AS OrderStatus, NULL AS line, NULL AS reason FROM raw_orders
        WHERE o_orderkey % 11 <> 0 AND o_orderkey % 13 <> 0 AND o_orderkey % 17 <> 0
        UNION ALL
        SELECT NULL, NULL, NULL, NULL,
               CASE WHEN o_orderkey % 11 = 0 THEN concat_ws(',', OrderID, CustomerID, OrderDate, coalesce(OrderStatus, ''), 'x')
                    WHEN o_orderkey % 13 = 0 THEN concat_ws(',', OrderID, CustomerID)
                    ELSE concat_ws(',', OrderID, CustomerID, OrderDate, '"' || coalesce(OrderStatus, '')) END,
               CASE WHEN o_orderkey % 11 = 0 THEN 'TOO_MANY_FIELDS' WHEN o_orderkey % 13 = 0 THEN 'TOO_FEW_FIELDS' ELSE 'OPEN_QUOTE' END
        FROM raw_orders WHERE o_orderkey % 11 = 0 OR o_orderkey % 13 = 0 OR o_orderkey % 17 = 0""",
    "reconcile_contents": """
        SELECT OrderID, CASE WHEN target_rows = 0 THEN 'MISSING' WHEN source_rows = 0 THEN 'EXTRA' ELSE 'CHANGED' END AS difference,
               CAST(source_rows AS BIGINT) AS source_rows, CAST(target_rows AS BIGINT) AS target_rows
        FROM (SELECT OrderID, gone, more, changed, CASE WHEN gone AND more THEN 0 WHEN gone OR changed THEN copies - CASE WHEN more THEN copies ELSE 0 END ELSE 0 END AS source_rows,
                     CASE WHEN changed AND NOT gone THEN copies WHEN more AND NOT gone THEN copies ELSE 0 END AS target_rows
              FROM (SELECT OrderID, count(*) AS copies, any_value(o_orderkey % 89 = 0) AS gone, any_value(o_orderkey % 83 = 0) AS more,
                           any_value(o_orderkey % 97 = 0) AS changed FROM raw_orders GROUP BY OrderID))
        WHERE source_rows > 0 OR target_rows > 0""",
    "clustered_read": """
        SELECT job_name, task_name, task_run_id, source_count, status FROM task_log
        WHERE job_name BETWEEN 'click' AND 'purchase' AND source_count BETWEEN 250 AND 400""",
    "upsert_since_watermark": f"""
        SELECT * REPLACE (strftime(ingest_ts, {ISO}) AS ingest_ts) FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY ingest_ts DESC) = 1""",
    "upsert_table_load": f"""
        SELECT * REPLACE (strftime(ingest_ts, {ISO}) AS ingest_ts),
               (SELECT count(*) FROM raw_customers WHERE ingest_ts < TIMESTAMP '2024-01-03 00:00:00') AS load_1,
               (SELECT count(*) FROM raw_customers WHERE ingest_ts >= TIMESTAMP '2024-01-03 00:00:00') AS load_2,
               CAST(0 AS BIGINT) AS load_3
        FROM raw_customers QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY ingest_ts DESC) = 1""",
    "merge_increment": "SELECT * FROM new_products",
    "snapshot_read": """
        SELECT *, CAST(1 AS BIGINT) AS version FROM old_products
        UNION ALL SELECT *, CAST(2 AS BIGINT) FROM new_products""",
    "rename_columns": f"""
        SELECT {_ITEM_COLUMNS}, PricePerUnit AS price_per_unit, strftime(ingest_ts, {ISO}) AS ingest_ts
        FROM raw_items""",
    "align_schema": f"""
        SELECT OrderID AS order_id, CustomerID AS customer_id, OrderDate AS order_date, OrderStatus AS order_status,
               strftime(ingest_ts, {ISO}) AS updated_ts FROM raw_orders""",
    "guarded_int": """
        SELECT OrderItemID, Quantity,
               CASE WHEN regexp_matches(Quantity, '^[0-9]+$') THEN TRY_CAST(Quantity AS INTEGER) END AS quantity_int
        FROM raw_items""",
    "guarded_double": """
        SELECT ProductID, Price, CASE WHEN regexp_matches(Price, '^[0-9]+([.][0-9]+)?$')
                                      THEN TRY_CAST(Price AS DOUBLE) END AS price_double
        FROM raw_products""",
    "date_parse": """
        SELECT CustomerID, SignUpDate, CAST(TRY_CAST(SignUpDate AS DATE) AS VARCHAR) AS signup_date
        FROM raw_customers""",
    "audit_stamp": _stamped("raw_products", "ProductID, ProductName"),
    "dedup_by_key": f"""
        SELECT * REPLACE (strftime(ingest_ts, {ISO}) AS ingest_ts) FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY CustomerID
          ORDER BY FullName DESC, Email DESC, SignUpDate DESC, City DESC, Country DESC, ingest_ts DESC) = 1""",
    "orders_with_null_status": f"""
        SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date), '{STAMP}' AS updated_ts FROM any_orders
        WHERE order_status IS NULL OR order_status <> 'CANCELLED'""",
    "active_tasks": "SELECT * FROM active",
    "active_tasks_of_group": "SELECT * FROM active WHERE job_name = 'click' AND grouping_id = 'G1'",
    "watermark_per_task": f"""
        SELECT job_name, task_name, strftime(coalesce(max(filter_end_ts) FILTER (WHERE status = 'COMPLETED'),
                                                      TIMESTAMP '1900-01-01 00:00:00'), {ISO}) AS watermark
        FROM task_log GROUP BY job_name, task_name""",
    "watermark_of_compacted_log": f"""
        SELECT w.job_name, w.task_name, w.watermark, l.last_processed_file FROM (
          SELECT job_name, task_name, strftime(coalesce(max(filter_end_ts) FILTER (WHERE status = 'COMPLETED'),
                                                        TIMESTAMP '1900-01-01 00:00:00'), {ISO}) AS watermark
          FROM task_log GROUP BY job_name, task_name) w
        JOIN (SELECT t.job_name, t.task_name,
                     coalesce(f.last_processed_file, t.job_name || '_19000101000000.csv') AS last_processed_file
              FROM (SELECT DISTINCT job_name, task_name FROM task_log) t LEFT JOIN (
                SELECT job_name, task_name, last_processed_file FROM task_log WHERE status = 'COMPLETED'
                QUALIFY row_number() OVER (PARTITION BY job_name, task_name
                                           ORDER BY execution_start_ts DESC, task_run_id DESC) = 1) f
                ON t.job_name = f.job_name AND t.task_name = f.task_name) l
          ON w.job_name = l.job_name AND w.task_name = l.task_name""",
    "stream_without_repeats": """
        SELECT event_type, CASE WHEN late THEN 'late' ELSE 'accepted' END AS state,
               CAST(sum(copies) AS BIGINT) AS n_rows, CAST(sum(copies * event_id) AS BIGINT) AS ids
        FROM (SELECT event_id, event_type, late, CASE WHEN late AND event_id % 7 = 0 THEN 2 ELSE 1 END AS copies
              FROM (SELECT event_id, event_type, event_id % 10 = 3 AND (epoch_us(ts) - first) * 3 // greatest(1, last - first) = 0 AS late
                    FROM events, (SELECT epoch_us(min(ts)) AS first, epoch_us(max(ts)) AS last FROM events)))
        GROUP BY ALL""",
    "last_file_per_task": """
        SELECT t.job_name, t.task_name,
               coalesce(f.last_processed_file, t.job_name || '_19000101000000.csv') AS last_processed_file
        FROM (SELECT DISTINCT job_name, task_name FROM task_log) t LEFT JOIN (
          SELECT job_name, task_name, last_processed_file FROM task_log WHERE status = 'COMPLETED'
          QUALIFY row_number() OVER (PARTITION BY job_name, task_name
                                     ORDER BY execution_start_ts DESC, task_run_id DESC) = 1) f
          ON t.job_name = f.job_name AND t.task_name = f.task_name""",
    "restart_set": """
        SELECT DISTINCT job_name, parent_run_id, task_name FROM task_log l
        WHERE status = 'FAILED'
          AND NOT EXISTS (SELECT 1 FROM task_log o
                          WHERE o.job_name = l.job_name AND o.parent_run_id = l.parent_run_id
                            AND o.task_name = l.task_name AND o.status IN ('INITIATED', 'NOT STARTED', 'COMPLETED'))
          AND EXISTS (SELECT 1 FROM active a WHERE a.job_name = l.job_name AND a.task_name = l.task_name)""",
    "tasks_to_start": """
        SELECT * FROM (
          WITH own AS (SELECT * FROM active WHERE job_name = 'error' AND grouping_id = 'G1'),
               run AS (SELECT * FROM task_log WHERE job_name = 'error' AND parent_run_id = 'R1'),
               only_failed AS (SELECT task_name FROM run GROUP BY task_name HAVING bool_and(status = 'FAILED'))
          SELECT * FROM own
          WHERE task_name IN (SELECT task_name FROM only_failed)
             OR NOT EXISTS (SELECT 1 FROM run WHERE status = 'FAILED' AND task_name IN (SELECT task_name FROM own)))""",
    "run_rank": f"""
        SELECT job_name, parent_run_id, job_id, task_name, task_run_id, status,
               strftime(execution_start_ts, {ISO}) AS execution_start_ts,
               row_number() OVER (PARTITION BY job_name, parent_run_id
                                  ORDER BY execution_start_ts DESC, task_run_id DESC) AS rn
        FROM task_log""",
    "reconcile_rows": "SELECT task_run_id, source_count, target_count, load_status, load_message FROM verdicts",
    "reconcile_loads": """
        SELECT job_name, count(*) AS loads, CAST(sum(CASE WHEN load_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT)
                 AS failed_loads,
               CAST(sum(source_count) AS BIGINT) AS source_rows, CAST(sum(target_count) AS BIGINT) AS target_rows
        FROM verdicts GROUP BY job_name""",
    "task_state_latest": f"""
        SELECT job_name, parent_run_id, task_name, task_run_id, status,
               strftime(execution_start_ts, {ISO}) AS execution_start_ts
        FROM task_log
        QUALIFY row_number() OVER (PARTITION BY job_name, parent_run_id, task_name
                                   ORDER BY execution_start_ts DESC, task_run_id DESC) = 1""",
    "run_log_rows": f"""
        SELECT job_id, parent_run_id, task_run_id, '{STAMP}' AS create_dt,
               CASE WHEN load_status = 'FAILED' THEN 'CRITICAL:' ELSE 'INFO:' END || load_message AS primary_message,
               CAST(source_count AS BIGINT) AS records_in, CAST(target_count AS BIGINT) AS records_out
        FROM verdicts""",
    "run_report": """
        SELECT job_name, CAST(sum(CASE WHEN load_status = 'COMPLETED' THEN 1 ELSE 0 END) AS BIGINT) AS info_rows,
               CAST(sum(CASE WHEN load_status = 'FAILED' THEN 1 ELSE 0 END) AS BIGINT) AS critical_rows,
               CAST(sum(source_count) AS BIGINT) AS records_in, CAST(sum(target_count) AS BIGINT) AS records_out,
               round(max(seconds) / 60.0, 2) AS longest_minutes,
               CAST(sum(seconds) // 3600 AS BIGINT) AS total_hours,
               CAST(sum(seconds) % 3600 // 60 AS BIGINT) AS total_minutes,
               CAST(sum(seconds) % 60 AS BIGINT) AS total_seconds
        FROM verdicts GROUP BY job_name""",
    "run_durations": """
        SELECT task_run_id, round(seconds / 60.0, 2) AS minutes,
               strftime(execution_start_ts, '%Y-%m-%d') || strftime(execution_end_ts, ' %H:%M:%S.%f') AS day_with_time,
               seconds // 3600 AS hours, seconds % 3600 // 60 AS whole_minutes, seconds % 60 AS seconds
        FROM task_log""",
    "procedure_log": """
        SELECT task_run_id,
               CASE WHEN run % 3 = 2 THEN
                      'Procedure Failed : ' || job_id || ' at the transaction no : ' || (run % 100)
                      || ', while doing  ' || job_name || ' for the table ' || task_name
                      || ',  Error_description : ' || CASE WHEN run % 10 = 0 THEN 'done' ELSE '' END
                    WHEN run % 10 = 0 THEN 'done'
                    WHEN run % 3 = 0 THEN
                      'Sql_seq: ' || (run % 100) || ', No of records ' || job_name || ' in the  ' || task_name
                      || ' table is ' || source_count
                    ELSE 'Success.Minutes to execute  sp: ' || printf('%.2f', seconds / 60.0) END AS primary_message
        FROM (SELECT *, CAST(task_run_id AS BIGINT) AS run FROM task_log)""",
    "retention_filter": f"""
        SELECT task_run_id, strftime(execution_start_ts, {ISO}) AS execution_start_ts FROM task_log
        WHERE execution_start_ts >= TIMESTAMP '2024-02-10 00:00:00' - INTERVAL 30 DAY""",
    "file_lineage": """
        SELECT path, size, regexp_extract(path, '([^/]*/[^/]*/[^/]*/[^/]*)$', 1) AS FILE_NAME,
               nullif(regexp_extract(path, '_([^_/]*)[.][^./]*$', 1), '') AS FILE_TS FROM listing""",
    "latest_file": f"""
        SELECT job_name, path, strftime(modified, {ISO}) AS modified FROM listing WHERE path LIKE '%202401%'
        QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY listing.modified DESC, path DESC) = 1""",
    "latest_file_monthly": f"""
        SELECT job_name, path, strftime(modified, {ISO}) AS modified FROM listing WHERE contains(path, 'monthly')
        QUALIFY row_number() OVER (PARTITION BY job_name ORDER BY listing.modified DESC, path DESC) = 1""",
    "new_files_since": f"""
        SELECT path, size, strftime(modified, {ISO}) AS modified FROM listing l LEFT JOIN (
          SELECT job_name, task_name, max(filter_end_ts) AS mark FROM task_log
          WHERE status = 'COMPLETED' GROUP BY job_name, task_name) w
          ON l.job_name = w.job_name AND l.task_name = w.task_name
        WHERE l.modified > coalesce(mark, TIMESTAMP '1900-01-01 00:00:00')""",
    "file_manifest": f"""
        SELECT feed, true AS filled, true AS named, true AS in_order
        FROM (SELECT DISTINCT {_FEED} AS feed FROM raw_orders UNION ALL SELECT -1)""",
    "per_file_counts": f"""
        SELECT {_FEED} AS feed, count(*) AS row_count FROM raw_orders GROUP BY 1
        UNION ALL SELECT -1, CAST(0 AS BIGINT)""",
    "ingest_csv_schema": f"""
        SELECT ProductID, ProductName, Category, Brand, nullif(Price, '') AS Price, '{STAMP}' AS ingest_ts
        FROM raw_products""",
    "ingest_null_marker": f"SELECT {_PRODUCT_PAYLOAD} FROM raw_products",
    "ingest_delimited": f"SELECT {_CUSTOMER_PAYLOAD} FROM raw_customers",
    "ingest_quoted": """
        SELECT ProductID, ' the "' || ProductName || '", new, 12"' AS Label, Category FROM raw_products""",
    "ingest_skip_rows": f"""
        SELECT {_FEED} AS feed, {_ORDER_PAYLOAD} FROM raw_orders
        QUALIFY row_number() OVER (PARTITION BY o_orderkey // 5000 ORDER BY o_orderkey) > 3""",
    "ingest_incremental": f"""
        SELECT {_CUSTOMER_PAYLOAD}, '{STAMP}' AS ingest_ts, strftime(ingest_ts, '%Y-%m-%d') AS wave, false AS has_file_ts,
               CASE WHEN ingest_ts < TIMESTAMP '2024-01-03' THEN CAST(0 AS BIGINT) ELSE 1 END AS ingest_batch
        FROM raw_customers""",
    "ingest_task": f"SELECT {_ORDER_PAYLOAD}, {_FEED} AS feed, 'COMPLETED COMPLETED' AS states FROM raw_orders",
    "load_append": f"""
        SELECT * REPLACE (strftime(ingest_ts, {ISO}) AS ingest_ts) FROM (
          SELECT * FROM raw_products UNION ALL SELECT * FROM raw_products)""",
    "load_overwrite": f"SELECT * REPLACE (strftime(ingest_ts, {ISO}) AS ingest_ts) FROM raw_products",
    "load_append_audit": f"SELECT {_PRODUCT_PAYLOAD}, 'loader' AS LOAD_BY, '{STAMP}' AS LOAD_TS FROM raw_products",
    "load_overwrite_audit": f"""
        SELECT {_ORDER_PAYLOAD}, 'loader' AS LOAD_BY, '{STAMP}' AS LOAD_TS, CAST(NULL AS VARCHAR) AS FILE_TS,
               {_FEED} AS feed FROM raw_orders""",
    "load_overwrite_load_by": f"SELECT {_ORDER_PAYLOAD}, 'loader' AS LOAD_BY FROM raw_orders",
    "load_crud_audit": f"""
        SELECT {_CUSTOMER_PAYLOAD}, 'T1' AS CRT_BY, '{STAMP}' AS CRT_TS, 'T1' AS UPD_BY, '{STAMP}' AS UPD_TS
        FROM raw_customers""",
    "load_from_query": "SELECT * FROM m_products UNION ALL SELECT * FROM m_products",
    "load_counts": _per_table(_RAW, "count(*) AS source_count, count(*) AS target_count, 'COMPLETED' AS status"),
    "truncate_layer": _truncated(),
    "table_loads": """
        SELECT 'appended' AS target, Country AS name, count(*) AS amount, CAST(NULL AS VARCHAR) AS city,
               'COMPLETED COMPLETED COMPLETED' AS states
        FROM raw_customers WHERE ingest_ts < TIMESTAMP '2024-01-03 00:00:00' GROUP BY Country
        UNION ALL SELECT part, Country, count(*), NULL, 'COMPLETED COMPLETED COMPLETED'
        FROM raw_customers, (VALUES ('appended'), ('overwritten')) t(part) GROUP BY part, Country
        UNION ALL SELECT 'merged', CustomerID, NULL, City, 'COMPLETED COMPLETED COMPLETED' FROM raw_customers
        QUALIFY row_number() OVER (PARTITION BY CustomerID ORDER BY ingest_ts DESC) = 1""",
    "not_started": """
        SELECT DISTINCT job_name, 'J1' AS job_id, 'R1' AS parent_run_id, task_name, 'NOT STARTED' AS status FROM active""",
    "materialize": "SELECT *, 'NOT STARTED' AS running_status_tracker FROM active",
    "schema_conformance": _conformance(),
    "gold_daily_sales_bucketed": "SELECT * REPLACE (CAST(order_date AS VARCHAR) AS order_date) FROM m_daily",
    "medallion_refresh": """
        SELECT 'daily_sales' AS mart, CAST(order_date AS VARCHAR) AS mart_key, CAST(total_orders AS DOUBLE) AS total,
               total_sales AS amount FROM m_daily
        UNION ALL SELECT 'customer_lifetime_value', customer_id, total_orders, lifetime_value FROM m_ltv
        UNION ALL SELECT 'top_products', product_id, total_quantity, total_revenue FROM m_products
        UNION ALL SELECT 'category_sales', category, total_quantity, total_revenue FROM m_categories""",
}

ORACLE: dict[str, str] = {name: _select(body) for name, body in _BODIES.items()}
