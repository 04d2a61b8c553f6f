"""Every registered query against its SQL, on the same tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry
from oremill.plans import gold
from oremill.workload import queries
from oremill.workload.oracle import ORACLE
from oremill.workload.queries import QUERIES
from tests.compare import connect, duckdb_rows, spark_rows


# All pairs of rows, or rows handed to Python.
UNSCALABLE = ("CartesianProduct", "NestedLoopJoin", "Python", "InPandas", "InArrow")


@pytest.fixture(scope="module")
def duck(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLE) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, sf_dir, duck, name):
    result = QUERIES[name](spark, sf_dir)
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert not [node for node in UNSCALABLE if node in plan]
    columns, expected = duckdb_rows(duck, ORACLE[name])
    assert sorted(result.columns) == columns
    assert spark_rows(result) == expected


def test_entry_has_rows(spark):
    result = entry.entry(spark)
    assert result.columns == ["order_date", "total_orders", "total_sales"]
    assert not result.isEmpty()


def test_marts_of_all_layers_share_the_sums_of_items(spark):
    """Items are read for two sums, not for each of four marts, and the marts are the same as from the items."""
    layers = queries._layers(spark, "/root/testdata/sf0.001")
    clean, marts = layers["silver"], layers["gold"]
    customers, products, orders, items = (clean[t] for t in ("customers", "products", "orders", "order_items"))
    from_items = {
        "daily_sales": gold.daily_sales(orders, items),
        "customer_lifetime_value": gold.customer_lifetime_value(customers, orders, items),
        "top_products": gold.top_products(products, items),
        "category_sales": gold.category_sales(products, items),
    }
    read = set(items.inputFiles())
    for name, mart in marts.items():
        assert not read & set(mart.inputFiles()), name
        rows, expected = (sorted(map(str, queries.portable(some).collect())) for some in (mart, from_items[name]))
        assert rows == expected and rows, name
