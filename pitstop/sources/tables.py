"""Adapter from the driver's TPC-H-style Parquet tables onto the e-commerce
model (customers, products, orders, order_items).

Every adapter is a pure projection (plus the tiny nation lookup), so column
pruning and filter pushdown reach the Parquet scan unchanged.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

# Fixed values of the mapping (must stay as they are for the oracle twins):
# order status letter -> status name; 'F' (fulfilled) plays "completed".
STATUS_NAMES = {"F": "completed", "O": "pending", "P": "returned"}
# signup_date is not in the test data: derived as base + (key mod 1500) days.
SIGNUP_BASE = dt.date(1995, 1, 1)
SIGNUP_SPREAD_DAYS = 1500

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


# Declared schemas of the driver tables: reading with a schema skips the
# footer-inference job Spark otherwise launches for every read.
DRIVER_SCHEMAS = {
    "region": "r_regionkey int, r_name string",
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": ("p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
             "p_retailprice double"),
    "orders": ("o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
               "o_orderdate timestamp_ntz, o_orderpriority string"),
    "lineitem": ("l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
                 "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
                 "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"),
    "events": ("event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
               "props string"),
}


def raw(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    schema = DRIVER_SCHEMAS.get(name)
    return spark.read.schema(schema).parquet(path) if schema else spark.read.parquet(path)


def _status_sql(col: str) -> str:
    whens = " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_NAMES.items())
    return f"CASE {col} {whens} END"


# Each adapter is one projection written as SQL text (one JVM call, not one
# per expression node).

def customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    c = raw(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    # nation is a 25-row dimension: the planner broadcasts it from its size.
    n = raw(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return (c.join(n, c.c_nationkey == n.n_nationkey, "left")
            .selectExpr("c_custkey AS customer_id",
                        f"date_add(DATE '{SIGNUP_BASE.isoformat()}', "
                        f"CAST(c_custkey % {SIGNUP_SPREAD_DAYS} AS INT)) AS signup_date",
                        "n_name AS country"))


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS order_id", "o_custkey AS customer_id", "o_orderdate AS order_date",
        f"{_status_sql('o_orderstatus')} AS status",
        "CAST(o_totalprice AS DECIMAL(12,2)) AS order_total")


def order_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items without price; `operators.rollup.item_price_lookup` adds it.

    ``order_item_id`` is derived as ``order_id * 8 + line number``; the test
    data repeats some (order, line) pairs, so it is not unique there."""
    return raw(spark, sf_dir, "lineitem").selectExpr(
        "l_orderkey * 8 + l_linenumber AS order_item_id", "l_orderkey AS order_id",
        "l_partkey AS product_id", "CAST(l_quantity AS INT) AS quantity")


def products(spark: SparkSession, sf_dir: str) -> DataFrame:
    return raw(spark, sf_dir, "part").selectExpr(
        "p_partkey AS product_id", "p_name AS product_name", "p_type AS category",
        "CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price")


# DuckDB twins of the adapters (used by the oracle SQL strings).
ORACLE_CTES = f"""
m_customers AS (
    SELECT c.c_custkey AS customer_id,
           DATE '{SIGNUP_BASE.isoformat()}' + CAST(c.c_custkey % {SIGNUP_SPREAD_DAYS} AS INTEGER) AS signup_date,
           n.n_name AS country
      FROM customer c LEFT JOIN nation n ON c.c_nationkey = n.n_nationkey
),
m_orders AS (
    SELECT o_orderkey AS order_id, o_custkey AS customer_id, o_orderdate AS order_date,
           CASE o_orderstatus {' '.join(f"WHEN '{k}' THEN '{v}'" for k, v in STATUS_NAMES.items())} END AS status,
           CAST(o_totalprice AS DECIMAL(12,2)) AS order_total
      FROM orders
),
m_items AS (
    SELECT l_orderkey * 8 + l_linenumber AS order_item_id, l_orderkey AS order_id,
           l_partkey AS product_id, CAST(l_quantity AS INTEGER) AS quantity
      FROM lineitem
),
m_products AS (
    SELECT p_partkey AS product_id, p_name AS product_name, p_type AS category,
           CAST(p_retailprice AS DECIMAL(10,2)) AS unit_price
      FROM part
)"""
