"""Drift of logged scoring inputs against the training dataset partition."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from pitstop.operators.drift import DEFAULT_BUCKETS, expected_profile, psi_report, unpivot_features
from pitstop.plans.stream_jobs import run_windowed_drift
from pitstop.sources import datasets
from pitstop.sources.readers import read_csv_table
from pitstop.sources.schemas import FEATURE_COLUMNS, PREDICTION_LOG
from pitstop.streaming.drift import windowed_psi_stream


def read_log(spark: SparkSession, log: DataFrame | str) -> DataFrame:
    """A prediction log: a frame, a Parquet path or a path that ends in .csv."""
    if not isinstance(log, str):
        return log
    return read_csv_table(spark, log, PREDICTION_LOG) if log.rstrip("/").endswith(".csv") else spark.read.parquet(log)


def log_drift(spark: SparkSession, dataset_path: str, cutoff, log: DataFrame | str,
              buckets: int = DEFAULT_BUCKETS, edge_digits: int | None = None) -> DataFrame:
    """PSI per feature: expected = the dataset partition of ``cutoff``,
    actual = the prediction log.  Features missing from either side are
    skipped."""
    expected = datasets.read_dataset(spark, dataset_path, cutoff)
    return psi_report(expected, read_log(spark, log), FEATURE_COLUMNS, buckets, edge_digits)


def log_windowed_drift(spark: SparkSession, dataset_path: str, cutoff, log: DataFrame | str, ts_col: str = "logged_at",
                       window: str = "1 day", edge_digits: int | None = None, streaming: bool = False,
                       slide: str | None = None) -> DataFrame:
    """PSI per (window, feature) of the logged inputs against the dataset
    partition of ``cutoff``, in batch or through the stream; the windows
    overlap if a ``slide`` is given."""
    rows = read_log(spark, log)
    features = [f for f in FEATURE_COLUMNS if f in rows.columns]
    live = unpivot_features(rows, features, keep=[ts_col])
    expected = unpivot_features(datasets.read_dataset(spark, dataset_path, cutoff), features)
    if streaming:
        return run_windowed_drift(spark, live, "feature", "value", ts_col, window, edge_digits=edge_digits, expected=expected,
                                  slide=slide).drop("window_end")
    profile = expected_profile(expected, "feature", "value", edge_digits=edge_digits)
    return windowed_psi_stream(live, profile, "feature", "value", ts_col, window, slide).drop("window_end")
