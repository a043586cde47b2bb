"""Dirty variants of the model tables, derived from every row of the driver
tables: what the quality rules, the fills and the joins must cope with.

Rules by key: signup dates missing, customers repeated, order dates missing
and at odd seconds of the day, orders of unknown customers, negative totals,
items of unknown orders and products, items without a product.
``DIRTY_CTES`` are the DuckDB twins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitstop.sources import tables as tb
from pitstop.sources.tables import ORACLE_CTES, products  # noqa: F401 (products are clean)

_SIGNUP = "CASE WHEN customer_id % 40 <> 0 THEN signup_date END AS signup_date"
_REPEATED = "customer_id % 200 = 7"
_BUYER = "CASE WHEN order_id % 97 = 0 THEN customer_id + 100000000 ELSE customer_id END AS customer_id"
_TOTAL = "CASE WHEN order_id % 211 = 0 THEN CAST(-900000 AS DECIMAL(12,2)) ELSE order_total END AS order_total"
_ORDER = "CASE WHEN order_id % 89 = 0 THEN order_id + 1000000000 ELSE order_id END AS order_id"
_PRODUCT = ("CASE WHEN order_item_id % 71 = 0 THEN NULL WHEN order_item_id % 73 = 0 THEN product_id + 1000000000 "
            "ELSE product_id END AS product_id")


def _date(shifted: str) -> str:
    return f"CASE WHEN order_id % 50 <> 0 THEN {shifted} END AS order_date"


def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = tb.customers(spark, sf_dir).selectExpr("customer_id", _SIGNUP, "country")
    return c.unionAll(c.where(_REPEATED))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    late = _date("order_date + make_dt_interval(0, 0, 0, order_id % 86400)")
    return tb.orders(spark, sf_dir).selectExpr("order_id", _BUYER, late, "status", _TOTAL)


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tb.order_items(spark, sf_dir).selectExpr("order_item_id", _ORDER, _PRODUCT, "quantity")


DIRTY_CTES = ORACLE_CTES
for _name in ("customers", "orders", "items"):
    DIRTY_CTES = DIRTY_CTES.replace(f"m_{_name} AS", f"clean_{_name} AS")
DIRTY_CTES += f""",
m_customers AS (
    SELECT customer_id, {_SIGNUP}, country FROM clean_customers
    UNION ALL SELECT customer_id, {_SIGNUP}, country FROM clean_customers WHERE {_REPEATED}
),
m_orders AS (
    SELECT order_id, {_BUYER}, {_date("order_date + to_seconds(order_id % 86400)")}, status, {_TOTAL} FROM clean_orders
),
m_items AS (
    SELECT order_item_id, {_ORDER}, {_PRODUCT}, quantity FROM clean_items
)"""
