import pytest
from pyspark.sql import functions as F

from pitstop import registry as R
from pitstop.operators import score as sc
from pitstop.operators import train as T
from pitstop.operators.split import stratified_split
from pitstop.operators.transform import training_rows
from pitstop.plans.scoring_job import ModelUnavailable, score_batch
from pitstop.session import scratch_path
from pitstop.sources import model_store
from pitstop.sources.schemas import SCORING_REQUEST

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def fitted(spark):
    rows = training_rows(R.features_at(spark, SF))
    sp = stratified_split(rows, "churned", "customer_id").checkpoint()
    best, models = T.train_and_select(sp, boosted_params={**T.BOOSTED_PARAMS, "n_estimators": 5})
    return best, models, sp


def test_train_and_select(fitted):
    best, models, _ = fitted
    assert [m.name for m in models] == [T.BASELINE, T.BOOSTED]
    for m in models:
        assert set(m.metrics) == {"accuracy", "precision", "recall", "f1", "roc_auc"}
        assert 0.0 <= m.metrics["accuracy"] <= 1.0
    assert best.name == T.select_best(models).name


def test_select_tie_goes_to_boosted():
    a = T.TrainedModel(T.BASELINE, None, {}, {"roc_auc": 0.7})
    b = T.TrainedModel(T.BOOSTED, None, {}, {"roc_auc": 0.7})
    assert T.select_best([a, b]).name == T.BOOSTED


def requests(spark):
    return spark.createDataFrame([
        (5, 120.5, None, None, None),          # F2a partial
        (-5, None, None, None, None),           # F2b negative
        (5, 250.0, 3, 40, 300),                 # F2c full
        (None, None, None, None, None),         # F2d all NULL
    ], SCORING_REQUEST)


def test_request_validation_and_defaults(spark):
    acc, rej = sc.split_requests(requests(spark))
    assert [r.reject_reason for r in rej.collect()] == ["order_count"]
    filled = sc.fill_defaults(acc).collect()
    assert [list(r.used_defaults_for) for r in filled] == [
        ["distinct_products", "recency_days", "tenure_days"], [],
        ["order_count", "total_spend", "distinct_products", "recency_days", "tenure_days"]]
    assert (filled[0].distinct_products, filled[0].recency_days, filled[0].tenure_days) == (0, 9999, 0)


def test_score_save_reload_identical(spark, fitted):
    best, _, _ = fitted
    path = scratch_path(spark, "model")
    model_store.save_model(best.model, path)
    loaded, source = model_store.load_model(["/nonexistent/model", path])
    assert source == f"fallback:{path}" and model_store.load_model([path])[1] == f"primary:{path}"
    acc, _ = sc.split_requests(requests(spark))
    a = sc.score(acc, best.model, "x").select("churn_score").collect()
    b = sc.score(acc, loaded, "x").select("churn_score").collect()
    assert a == b
    out = sc.score(acc, loaded, source).collect()
    assert all(0.0 <= r.churn_probability <= 1.0 and r.churn_prediction in (0, 1) for r in out)
    assert all(r.churn_prediction == int(r.churn_score >= 0.5) for r in out)


def test_score_batch_logs_and_refuses_without_model(spark, fitted):
    best, _, _ = fitted
    path = scratch_path(spark, "model")
    model_store.save_model(best.model, path)
    log, rej = scratch_path(spark, "log"), scratch_path(spark, "rej")
    score_batch(spark, requests(spark), [path], log, rej)
    score_batch(spark, requests(spark), [path], log, rej)
    assert spark.read.parquet(log).count() == 6 and spark.read.parquet(rej).count() == 2
    assert set(spark.read.parquet(log).columns) >= {"churn_probability", "logged_at"}
    with pytest.raises(ModelUnavailable):
        score_batch(spark, requests(spark), ["/nonexistent"])


def test_run_records(spark, fitted):
    best, models, _ = fitted
    df = T.log_runs(spark, T.run_records(models, best, cutoff=None, run_id="r1"))
    assert df.where(F.col("kind") == "metric").count() == 10
    assert df.where(F.col("selected")).select("model").distinct().first()[0] == best.name


def test_a_training_run_writes_its_records_and_roc_points(spark):
    from pitstop.plans.training_job import train_from_dataset
    from pitstop.sources import datasets
    rows = spark.range(400).selectExpr("id AS customer_id", "id % 9 AS order_count", "CAST(id % 50 AS DOUBLE) AS total_spend",
                                       "id % 5 AS distinct_products", "id % 300 AS recency_days", "id % 700 AS tenure_days",
                                       "CAST(id % 9 < 3 AS INT) AS churned")
    path, runs, roc = (scratch_path(spark, n) for n in ("features", "runs", "roc"))
    datasets.write_dataset(rows, path, "2020-01-01")
    best, _, _ = train_from_dataset(spark, path, "2020-01-01", runs_path=runs, roc_path=roc, names=(T.BASELINE,))
    logged = spark.read.parquet(runs)
    assert logged.where("name = 'n_features'").first().value == 5
    points = spark.read.parquet(roc)
    assert points.select("run_id").distinct().collect() == logged.select("run_id").distinct().collect()
    assert points.agg({"tpr": "max"}).first()[0] == 1.0 and best.metrics["roc_auc"] is not None
