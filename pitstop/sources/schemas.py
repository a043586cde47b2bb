"""Typed schemas of the e-commerce model and of the derived datasets.

Never infer schemas: CSV and streaming sources are read with these.
"""

from pyspark.sql import types as T

CUSTOMERS = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("first_name", T.StringType()),
    T.StructField("last_name", T.StringType()),
    T.StructField("email", T.StringType()),
    T.StructField("signup_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("marketing_opt_in", T.BooleanType()),
])

PRODUCTS = T.StructType([
    T.StructField("product_id", T.LongType(), False),
    T.StructField("product_name", T.StringType()),
    T.StructField("category", T.StringType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
    T.StructField("active", T.BooleanType()),
])

ORDERS = T.StructType([
    T.StructField("order_id", T.LongType(), False),
    T.StructField("customer_id", T.LongType()),
    T.StructField("order_date", T.TimestampNTZType()),
    T.StructField("status", T.StringType()),
    T.StructField("order_total", T.DecimalType(12, 2)),
])

ORDER_ITEMS = T.StructType([
    T.StructField("order_item_id", T.LongType(), False),
    T.StructField("order_id", T.LongType()),
    T.StructField("product_id", T.LongType()),
    T.StructField("quantity", T.IntegerType()),
    T.StructField("unit_price", T.DecimalType(10, 2)),
])

TABLES = {
    "customers": CUSTOMERS,
    "products": PRODUCTS,
    "orders": ORDERS,
    "order_items": ORDER_ITEMS,
}

# Model inputs, in the order the model and the scoring request use them.
FEATURE_COLUMNS = ["order_count", "total_spend", "distinct_products", "recency_days", "tenure_days"]
LABEL_COLUMN = "churned"
KEY_COLUMN = "customer_id"
REQUIRED_COLUMNS = [KEY_COLUMN] + FEATURE_COLUMNS + [LABEL_COLUMN]

FEATURE_TABLE = T.StructType([
    T.StructField("customer_id", T.LongType(), False),
    T.StructField("signup_date", T.DateType()),
    T.StructField("country", T.StringType()),
    T.StructField("order_count", T.LongType()),
    T.StructField("last_order_date", T.TimestampNTZType()),
    T.StructField("total_spend", T.DoubleType()),
    T.StructField("distinct_products", T.LongType()),
    T.StructField("recency_days", T.LongType()),
    T.StructField("tenure_days", T.LongType()),
    T.StructField("orders_next_90d", T.LongType()),
    T.StructField("churned", T.IntegerType()),
])

SCORING_REQUEST = T.StructType([
    T.StructField("order_count", T.LongType()),
    T.StructField("total_spend", T.DoubleType()),
    T.StructField("distinct_products", T.LongType()),
    T.StructField("recency_days", T.LongType()),
    T.StructField("tenure_days", T.LongType()),
])

PREDICTION_LOG = T.StructType(
    SCORING_REQUEST.fields + [
        T.StructField("churn_probability", T.DoubleType()),
        T.StructField("logged_at", T.TimestampType()),
    ])
