"""Extract -> transform -> validate -> publish, as one Spark job per cutoff.

The transformed frame is checkpointed once into the shared checkpoint
folder, validated from there (one aggregate job) and written only if every
check passed, so bad data never reaches the dataset and nothing is computed
twice.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from pitstop.operators import features as ft
from pitstop.operators.quality import ValidationError, validate_report
from pitstop.operators.transform import transform_features
from pitstop.session import checkpoint_root
from pitstop.sources import datasets
from pitstop.sources import tables as tb


@dataclass
class PublishResult:
    path: str | None
    report: list[dict]
    rows: int

    @property
    def passed(self) -> bool:
        return all(r["passed"] for r in self.report)


def extract(spark: SparkSession, sf_dir: str, cutoff) -> DataFrame:
    return ft.feature_table(tb.customers(spark, sf_dir), tb.orders(spark, sf_dir),
                            tb.order_items(spark, sf_dir), cutoff)


def publish_features(df: DataFrame, out_path: str, cutoff, raise_on_fail: bool = True) -> PublishResult:
    """Transform, validate and publish one cutoff of the feature dataset."""
    checkpoint_root(df.sparkSession)
    staged = transform_features(df).checkpoint(eager=True)
    report = [r.asDict() for r in validate_report(staged).collect()]
    n = next((int(r["value"]) for r in report if r["check"] == "non_empty"), 0)
    failed = [r for r in report if not r["passed"]]
    if failed:
        if raise_on_fail:
            raise ValidationError(failed)
        return PublishResult(None, report, n)
    datasets.write_dataset(staged, out_path, cutoff)
    return PublishResult(out_path, report, n)


def build_dataset(spark: SparkSession, sf_dir: str, cutoff, out_path: str,
                  raise_on_fail: bool = True) -> PublishResult:
    return publish_features(extract(spark, sf_dir, cutoff), out_path, cutoff, raise_on_fail)
