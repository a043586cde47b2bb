"""Batch scoring job: requests -> (scores, quarantine) -> prediction log."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.functions.dates import as_date, days_between
from pitstop.operators import features as ft
from pitstop.operators.score import log_rows, score, split_requests
from pitstop.sources import datasets
from pitstop.sources.model_store import load_model


class ModelUnavailable(RuntimeError):
    pass


def requests_as_of(customers: DataFrame, orders: DataFrame, items: DataFrame, cutoff) -> DataFrame:
    """Scoring requests for every customer as known at ``cutoff``: history
    fields are NULL when the customer has no past order (or no item), so
    the defaults apply; tenure is negative for signups after the cutoff,
    which the request rule rejects."""
    cut = F.lit(as_date(cutoff))
    return (customers.select("customer_id", "signup_date")
            .join(ft.past_agg(orders, cutoff), "customer_id", "left")
            .join(ft.past_products(orders, items, cutoff), "customer_id", "left")
            .select("customer_id",
                    F.col("order_count").cast("long").alias("order_count"),
                    F.col("total_spend").cast("double").alias("total_spend"),
                    F.col("distinct_products").cast("long").alias("distinct_products"),
                    days_between(cut, F.to_date("last_order_date")).alias("recency_days"),
                    days_between(cut, F.col("signup_date")).alias("tenure_days")))


def score_batch(spark: SparkSession, requests: DataFrame, model_paths, log_path: str | None = None,
                rejects_path: str | None = None, cap_recency: int | None = None):
    """Score a batch; append the log and the quarantine when paths are given.
    Returns (scored, rejected)."""
    model, source = load_model(model_paths)
    if model is None:
        raise ModelUnavailable("no model could be loaded from " + ", ".join(model_paths))
    accepted, rejected = split_requests(requests)
    scored = score(accepted, model, source, cap_recency)
    if log_path:
        datasets.append_log(log_rows(scored), log_path)
    if rejects_path:
        rejected.write.mode("append").parquet(rejects_path)
    return scored, rejected
