"""Model training, evaluation and selection on Spark ML.

Pipelines are ``VectorAssembler -> StandardScaler(mean, std) -> classifier``:

* baseline: L2 logistic regression with inverse strength C.  sklearn sums
  the log-loss while Spark averages it, so ``regParam = 1 / (C * n_train)``;
  features are already scaled, so Spark's own standardization is off;
* boosted: gradient-boosted trees, logistic loss (200 rounds, depth 3,
  step 0.1, seed 42 by default).  Spark bins split candidates
  (``maxBins``) and takes a plain gradient step per leaf, so scores are
  close to, not equal to, other implementations.

Spark's StandardScaler divides by the sample standard deviation (sklearn by
the population one): a factor sqrt(n / (n - 1)) on the scaled values.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.operators.metrics import classification_metrics, roc_auc
from pitstop.session import checkpoint_root
from pitstop.sources.schemas import FEATURE_COLUMNS, LABEL_COLUMN

BASELINE = "baseline_logreg"
BOOSTED = "gradient_boosting"
BASELINE_PARAMS = {"C": 1.0, "max_iter": 1000}
BOOSTED_PARAMS = {"n_estimators": 200, "max_depth": 3, "learning_rate": 0.1, "seed": 42}


@dataclass
class TrainedModel:
    name: str
    model: PipelineModel
    params: dict
    metrics: dict = field(default_factory=dict)


def _stages(features: Sequence[str]):
    return [VectorAssembler(inputCols=list(features), outputCol="_features_raw", handleInvalid="error"),
            StandardScaler(inputCol="_features_raw", outputCol="features", withMean=True, withStd=True)]


def baseline_pipeline(n_train: int, features: Sequence[str] = FEATURE_COLUMNS,
                      params: dict = BASELINE_PARAMS) -> Pipeline:
    lr = LogisticRegression(featuresCol="features", labelCol=LABEL_COLUMN,
                            regParam=1.0 / (params["C"] * max(n_train, 1)), elasticNetParam=0.0,
                            standardization=False, maxIter=params["max_iter"], tol=params.get("tol", 1e-8))
    return Pipeline(stages=_stages(features) + [lr])


def boosted_pipeline(features: Sequence[str] = FEATURE_COLUMNS, params: dict = BOOSTED_PARAMS) -> Pipeline:
    gbt = GBTClassifier(featuresCol="features", labelCol=LABEL_COLUMN,
                        maxIter=params["n_estimators"], maxDepth=params["max_depth"],
                        stepSize=params["learning_rate"], lossType="logistic",
                        seed=params.get("seed", 42), checkpointInterval=10)
    return Pipeline(stages=_stages(features) + [gbt])


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Adds ``score`` (P(class 1)) and ``pred`` (0/1) and drops the ML
    working columns."""
    out = model.transform(df)
    out = (out.withColumn("score", vector_to_array("probability")[1])
           .withColumn("pred", F.col("prediction").cast("int")))
    return out.drop("_features_raw", "features", "rawPrediction", "probability", "prediction")


def evaluate(model: PipelineModel, test: DataFrame) -> dict:
    scored = predict(model, test).select(LABEL_COLUMN, "score", "pred").cache()
    m = classification_metrics(scored, LABEL_COLUMN, "pred").collect()[0].asDict()
    auc = roc_auc(scored, LABEL_COLUMN, "score").collect()[0]["auc"]
    scored.unpersist()
    return {"accuracy": m["accuracy"], "precision": m["precision"], "recall": m["recall"],
            "f1": m["f1"], "roc_auc": auc}


def fit(name: str, train: DataFrame, n_train: int | None = None,
        baseline_params: dict = BASELINE_PARAMS, boosted_params: dict = BOOSTED_PARAMS) -> TrainedModel:
    checkpoint_root(train.sparkSession)   # GBT checkpoints its lineage there
    if name == BASELINE:
        n = n_train if n_train is not None else train.count()
        return TrainedModel(name, baseline_pipeline(n, params=baseline_params).fit(train),
                            dict(baseline_params))
    if name == BOOSTED:
        return TrainedModel(name, boosted_pipeline(params=boosted_params).fit(train),
                            dict(boosted_params))
    raise ValueError(f"unknown model {name}")


def select_best(models: Sequence[TrainedModel]) -> TrainedModel:
    """Highest ROC AUC; on a tie the boosted model wins."""
    def key(m):
        auc = m.metrics.get("roc_auc")
        return (-1.0 if auc is None else auc, 1 if m.name == BOOSTED else 0)
    return max(models, key=key)


def train_and_select(split_rows: DataFrame, baseline_params: dict = BASELINE_PARAMS,
                     boosted_params: dict = BOOSTED_PARAMS,
                     names: Sequence[str] = (BASELINE, BOOSTED)) -> tuple[TrainedModel, list[TrainedModel]]:
    """Fit each model on the rows with ``is_test = false``, evaluate on the
    rest, return (best, all)."""
    train = split_rows.where(~F.col("is_test")).drop("is_test")
    test = split_rows.where(F.col("is_test")).drop("is_test")
    n_train = train.count()
    models = []
    for name in names:
        m = fit(name, train, n_train, baseline_params, boosted_params)
        m.metrics = evaluate(m.model, test)
        models.append(m)
    return select_best(models), models


def run_records(models: Sequence[TrainedModel], best: TrainedModel, cutoff=None,
                run_id: str | None = None) -> list[dict]:
    """Metric and parameter rows of one training run (small: models x metrics)."""
    run_id = run_id or uuid.uuid4().hex
    at = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    rows = []
    for m in models:
        rows.append({"run_id": run_id, "model": m.name, "kind": "param", "name": "n_features",
                     "value": float(len(FEATURE_COLUMNS)), "text": ",".join(FEATURE_COLUMNS),
                     "selected": m.name == best.name, "cutoff_date": cutoff, "logged_at": at})
        for k, v in m.metrics.items():
            rows.append({"run_id": run_id, "model": m.name, "kind": "metric", "name": k,
                         "value": None if v is None else float(v), "text": None,
                         "selected": m.name == best.name, "cutoff_date": cutoff, "logged_at": at})
        for k, v in m.params.items():
            rows.append({"run_id": run_id, "model": m.name, "kind": "param", "name": k,
                         "value": float(v) if isinstance(v, (int, float)) else None,
                         "text": str(v), "selected": m.name == best.name, "cutoff_date": cutoff,
                         "logged_at": at})
    return rows


RUNS_SCHEMA = ("run_id string, model string, kind string, name string, value double, text string, "
               "selected boolean, cutoff_date date, logged_at timestamp_ntz")


def log_runs(spark, rows: list[dict], path: str | None = None) -> DataFrame:
    df = spark.createDataFrame(rows, RUNS_SCHEMA)
    if path:
        df.write.mode("append").parquet(path)
    return df
