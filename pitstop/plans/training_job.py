"""Train-and-select from a published feature dataset (explicit cutoff):
read the partition -> drop incomplete rows, cap recency -> stratified split
(materialised once in the checkpoint folder) -> fit both models -> evaluate
-> pick by AUC -> save the best -> append run records and ROC points."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from pitstop.operators import train as trn
from pitstop.operators.metrics import roc_curve
from pitstop.operators.split import stratified_split
from pitstop.operators.transform import training_rows
from pitstop.session import checkpoint_root
from pitstop.sources import datasets
from pitstop.sources.model_store import save_model
from pitstop.sources.schemas import KEY_COLUMN, LABEL_COLUMN


def train_from_dataset(spark: SparkSession, dataset_path: str, cutoff, model_path: str | None = None,
                       runs_path: str | None = None, roc_path: str | None = None, test_fraction: float = 0.2, seed: int = 42,
                       baseline_params: dict = trn.BASELINE_PARAMS,
                       boosted_params: dict = trn.BOOSTED_PARAMS,
                       names=(trn.BASELINE, trn.BOOSTED)):
    checkpoint_root(spark)
    rows = training_rows(datasets.read_dataset(spark, dataset_path, cutoff))
    split = stratified_split(rows, LABEL_COLUMN, KEY_COLUMN, test_fraction, seed).checkpoint()
    best, models = trn.train_and_select(split, baseline_params, boosted_params, names)
    if model_path:
        save_model(best.model, model_path)
    run_id = uuid.uuid4().hex
    records = trn.log_runs(spark, trn.run_records(models, best, datasets.as_date(cutoff), run_id), runs_path)
    if roc_path:
        test = split.where(F.col("is_test")).drop("is_test")
        for m in models:
            points = roc_curve(trn.predict(m.model, test), LABEL_COLUMN, "score")
            (points.select(F.lit(run_id).alias("run_id"), F.lit(m.name).alias("model"), "*")
             .write.mode("append").parquet(roc_path))
    return best, models, records
