"""Order-total roll-up and the item price lookup."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def item_price_lookup(items: DataFrame, products: DataFrame) -> DataFrame:
    """Attach the product's unit price to each order item (NULL when the
    product is unknown)."""
    priced = items.join(products.select("product_id", "unit_price"), "product_id", "left")
    return priced.select(*items.columns, "unit_price")


def order_total_rollup(orders: DataFrame, priced_items: DataFrame) -> DataFrame:
    """Sum quantity * unit_price per order (exact decimal arithmetic),
    orders without items -> 0, rounded half-even to cents, next to the stored total."""
    lines = (priced_items.groupBy("order_id")
             .agg(F.sum(F.col("quantity") * F.col("unit_price")).alias("_items_total")))
    return (orders.select("order_id", "order_total")
            .join(lines, "order_id", "left")
            .select("order_id",
                    F.col("order_total").cast("double").alias("order_total"),
                    F.bround(F.coalesce(F.col("_items_total"), F.lit(0)), 2).cast("double")
                    .alias("rollup_total"))
            .withColumn("matches", F.col("order_total") == F.col("rollup_total")))
