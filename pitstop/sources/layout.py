"""Bucketed layout of the model tables for recurring feature jobs.

Written once, read by every later feature build:

* customers and orders bucketed (and sorted) by ``customer_id``: the
  per-customer order aggregate and the customer joins need no shuffle;
* order items bucketed by ``order_id``: the past-orders join shuffles only
  the (narrow, filtered) orders side, never the largest table.

Tables go to the shared checkpoint folder unless a root is given; they are
registered in the session catalog and must be read with ``spark.table`` for
the bucket spec to be used.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

from pitstop.session import checkpoint_root


def write_bucketed(df: DataFrame, table: str, key: str, num_buckets: int, path: str) -> DataFrame:
    # One task a bucket, so one file a bucket whatever the number of scan tasks.
    (df.repartition(num_buckets, key).write.mode("overwrite").format("parquet")
     .bucketBy(num_buckets, key).sortBy(key)
     .option("path", path)
     .saveAsTable(table))
    return df.sparkSession.table(table)


def bucketed_model(spark: SparkSession, customers: DataFrame, orders: DataFrame, items: DataFrame,
                   num_buckets: int, root: str | None = None) -> tuple[DataFrame, DataFrame, DataFrame]:
    root = (root or f"{checkpoint_root(spark).rstrip('/')}/layout").rstrip("/")
    tag = uuid.uuid4().hex[:10]
    c = write_bucketed(customers, f"pit_customers_{tag}", "customer_id", num_buckets,
                       f"{root}/customers_{tag}")
    o = write_bucketed(orders, f"pit_orders_{tag}", "customer_id", num_buckets, f"{root}/orders_{tag}")
    i = write_bucketed(items, f"pit_order_items_{tag}", "order_id", num_buckets,
                       f"{root}/order_items_{tag}")
    return c, o, i
