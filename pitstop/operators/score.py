"""Batch scoring: validate requests, fill defaults, predict, clamp, round,
threshold, and the prediction-log projection.

Request fields are nullable and must be NULL or >= 0; rows breaking the rule
go to a quarantine frame with the names of the failing fields.  Missing
fields take fixed defaults and are listed, in field order, in
``used_defaults_for``.  The response probability is rounded to 4 digits;
the threshold and the log use the unrounded value.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.functions.exprs import clamp, nonneg_or_null, null_field_names, threshold
from pitstop.operators.train import predict
from pitstop.sources.schemas import FEATURE_COLUMNS

# Defaults for missing request fields (field order = model order).
FEATURE_DEFAULTS = {"order_count": 0, "total_spend": 0.0, "distinct_products": 0,
                    "recency_days": 9999, "tenure_days": 0}
REQUEST_TYPES = {"order_count": "long", "total_spend": "double", "distinct_products": "long",
                 "recency_days": "long", "tenure_days": "long"}
PROBABILITY_DIGITS = 4


def _failed_fields(fields=FEATURE_COLUMNS):
    tagged = F.array(*[F.when(~nonneg_or_null(F.col(f)), F.lit(f)) for f in fields])
    return F.filter(tagged, lambda x: x.isNotNull())


def split_requests(df: DataFrame, fields=FEATURE_COLUMNS) -> tuple[DataFrame, DataFrame]:
    """(accepted, rejected); rejected carries ``reject_reason`` (failing
    field names joined by commas)."""
    tagged = df.withColumn("_failed", _failed_fields(fields))
    accepted = tagged.where(F.size("_failed") == 0).drop("_failed")
    rejected = (tagged.where(F.size("_failed") > 0)
                .withColumn("reject_reason", F.array_join("_failed", ","))
                .drop("_failed"))
    return accepted, rejected


def fill_defaults(df: DataFrame, cap_recency: int | None = None) -> DataFrame:
    """Fill missing fields with the defaults and add ``used_defaults_for``."""
    names = list(FEATURE_DEFAULTS)
    out = df.withColumn("used_defaults_for", null_field_names(names))
    for f, d in FEATURE_DEFAULTS.items():
        out = out.withColumn(f, F.coalesce(F.col(f).cast(REQUEST_TYPES[f]),
                                           F.lit(d).cast(REQUEST_TYPES[f])))
    if cap_recency is not None:
        out = out.withColumn("recency_days", F.least("recency_days", F.lit(int(cap_recency))))
    return out


def score(requests: DataFrame, model: PipelineModel, model_source: str,
          cap_recency: int | None = None) -> DataFrame:
    """Score accepted requests -> inputs after defaults, ``churn_score``
    (unrounded, clamped to [0, 1]), ``churn_probability`` (rounded),
    ``churn_prediction`` (0/1), ``model_source``, ``used_defaults_for``."""
    scored = predict(model, fill_defaults(requests, cap_recency))
    return finished(scored, F.col("score"), model_source).drop("score", "pred")


def score_by(requests: DataFrame, formula, model_source: str, cap_recency: int | None = None) -> DataFrame:
    """:func:`score` with a column over the filled fields in place of a model."""
    return finished(fill_defaults(requests, cap_recency), formula, model_source)


def finished(scored: DataFrame, raw, model_source: str) -> DataFrame:
    """Clamp, round half-even and threshold a raw score."""
    s = clamp(raw)
    return (scored.withColumn("churn_score", s)
            .withColumn("churn_probability", F.bround(s, PROBABILITY_DIGITS))
            .withColumn("churn_prediction", threshold(s))
            .withColumn("model_source", F.lit(model_source)))


def log_rows(scored: DataFrame, keep=()) -> DataFrame:
    """Prediction-log projection: optional key columns, inputs after
    defaults, the unrounded probability and the UTC log time."""
    return scored.select(*keep, *FEATURE_COLUMNS,
                         F.col("churn_score").alias("churn_probability"),
                         F.current_timestamp().alias("logged_at"))
