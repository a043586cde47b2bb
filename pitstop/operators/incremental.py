"""Feature tables for one cutoff after another, without reading history again.

The state of a cutoff is a version of three datasets:

* ``totals``: a row a customer (past orders, spend in units, last date,
  distinct products);
* ``pairs``: the (customer, product) pairs that this cutoff saw first; all
  versions together are the distinct pairs so far;
* ``pending``: orders that are still ahead of the cutoff, with their products.

A new cutoff folds in what has arrived since the last one: orders that were
pending or are new and lie before it move to the totals, the others wait.  An
order that arrives late, dated before an earlier cutoff, counts from the next
fold on; the versions before it stay as they were known.  Running a fold again
overwrites its own version."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.functions.dates import as_date
from pitstop.operators.features import COMPLETED, _finish, end_sql, money_units_sql, ts_sql
from pitstop.sources import datasets


def _version(spark: SparkSession, path: str, name: str, cutoff, schema: str) -> DataFrame:
    return spark.createDataFrame([], schema) if cutoff is None else datasets.read_version(spark, f"{path}/{name}", cutoff)


TOTALS = "customer_id long, n_orders long, units {units}, last_date timestamp_ntz, n_products long"
PENDING = ("order_id long, customer_id long, order_date timestamp_ntz, status string, units {units}, "
           "products array<bigint>")


def fold(spark: SparkSession, path: str, previous, cutoff, orders: DataFrame, items: DataFrame) -> None:
    """Write the state of ``cutoff`` from that of ``previous`` (None for the
    first) and the ``orders`` and ``items`` that arrived in between; the items
    come with their order.  Orders without a date are never past or ahead and
    are left out."""
    path = path.rstrip("/")
    if previous is not None and as_date(previous) >= as_date(cutoff):
        raise ValueError(f"{cutoff} does not come after {previous}")
    amount, factor = money_units_sql(orders)
    units = "long" if factor else orders.schema["order_total"].dataType.simpleString()
    bought = (items.where("product_id IS NOT NULL").groupBy("order_id")
              .agg(F.collect_set(F.col("product_id").cast("long")).alias("products")))       # an order's products
    arrived = (orders.where("order_date IS NOT NULL")
               .selectExpr("order_id", "customer_id", "order_date", "status", f"CAST({amount} AS {units}) AS units")
               .join(bought, "order_id", "left"))
    waiting = _version(spark, path, "pending", previous, PENDING.format(units=units))
    known = waiting.unionByName(arrived)
    datasets.write_version(known.where(f"order_date > {ts_sql(cutoff)}"), f"{path}/pending", cutoff)

    past = known.where(f"order_date <= {ts_sql(cutoff)}")
    pairs = past.select("customer_id", F.explode("products").alias("product_id")).distinct()
    if previous is not None:
        before = (spark.read.parquet(f"{path}/pairs").where(F.col("cutoff_date") <= F.lit(as_date(previous)))
                  .select(F.col("customer_id").alias("_c"), F.col("product_id").alias("_p")))
        pairs = pairs.join(before, F.col("customer_id").eqNullSafe(F.col("_c")) & (F.col("product_id") == F.col("_p")), "left_anti")
    fresh = datasets.write_version(pairs, f"{path}/pairs", cutoff)

    step = past.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_orders"), F.sum("units").alias("units"),
                                           F.max("order_date").alias("last_date"))
    totals = (_version(spark, path, "totals", previous, TOTALS.format(units=units))
              .unionByName(step.withColumn("n_products", F.lit(0).cast("long")))
              .unionByName(fresh.groupBy("customer_id").agg(F.count(F.lit(1)).alias("n_products"))
                           .selectExpr("customer_id", "0L AS n_orders", f"CAST(NULL AS {units}) AS units",
                                       "CAST(NULL AS TIMESTAMP_NTZ) AS last_date", "n_products")))
    merged = totals.groupBy("customer_id").agg(
        F.sum("n_orders").alias("n_orders"), F.sum("units").cast(units).alias("units"), F.max("last_date").alias("last_date"),
        F.sum("n_products").alias("n_products"))
    datasets.write_version(merged, f"{path}/totals", cutoff)


def features_from_state(spark: SparkSession, path: str, cutoff, customers: DataFrame, money_scale: int = 2,
                        horizon_days: int = 90) -> DataFrame:
    """The feature table of a folded cutoff, with ``cutoff_date``.  Labels are
    counted over the orders that wait, so they are as known when the cutoff was
    folded."""
    path = path.rstrip("/")
    totals = datasets.read_version(spark, f"{path}/totals", cutoff)
    ahead = (datasets.read_version(spark, f"{path}/pending", cutoff)
             .where(f"status = '{COMPLETED}' AND order_date <= {end_sql(cutoff, horizon_days)}")
             .groupBy("customer_id").agg(F.count(F.lit(1)).alias("ahead")))
    exact = totals.schema["units"].dataType.simpleString() == "bigint"
    spend = f"units / {10.0 ** money_scale!r}D" if exact else "units"
    joined = (customers.select("customer_id", "signup_date", "country").join(totals, "customer_id", "left")
              .join(ahead, "customer_id", "left"))
    return (_finish(joined, cutoff, "n_orders", "last_date", spend, "n_products", "ahead")
            .withColumn("cutoff_date", F.lit(as_date(cutoff))))
