import math

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.sql import Window
from pyspark.sql import functions as F

from pitstop.operators import metrics as mt
from pitstop.operators.split import class_allocation, split_hash, stratified_split


def labelled(spark, n=1000, pos_every=7):
    return spark.range(n).select(F.col("id").alias("customer_id"),
                                 (F.col("id") % pos_every == 0).cast("int").alias("churned"))


def test_split_disjoint_complete_and_sized(spark):
    df = labelled(spark)
    out = stratified_split(df, "churned", "customer_id").cache()
    assert out.count() == 1000
    assert out.select("customer_id").distinct().count() == 1000
    counts = {(r.churned, r.is_test): r["count"] for r in out.groupBy("churned", "is_test").count().collect()}
    pos = 1000 // 7 + 1
    alloc = class_allocation({0: 1000 - pos, 1: pos}, 0.2)
    assert counts[(1, True)] == alloc[1] and counts[(0, True)] == alloc[0]
    assert alloc[0] + alloc[1] == math.ceil(0.2 * 1000)


def test_split_matches_plain_window_and_is_stable(spark):
    df = labelled(spark, 3000, 3)
    a = stratified_split(df, "churned", "customer_id")
    b = stratified_split(df.repartition(7), "churned", "customer_id")
    assert a.exceptAll(b).count() == 0
    alloc = class_allocation({r[0]: r[1] for r in df.groupBy("churned").count().collect()}, 0.2)
    tk = F.create_map(*[x for k, v in alloc.items() for x in (F.lit(k), F.lit(v))])
    w = Window.partitionBy("churned").orderBy(split_hash("customer_id", 42), "customer_id")
    oracle = df.withColumn("is_test", F.row_number().over(w) <= F.element_at(tk, F.col("churned")))
    assert a.exceptAll(oracle).count() == 0


def test_allocation_largest_remainder():
    assert class_allocation({0: 5, 1: 5}, 0.2) == {0: 1, 1: 1}
    got = class_allocation({0: 3, 1: 4}, 0.2)
    assert sum(got.values()) == math.ceil(0.2 * 7)


def frame(spark, rows):
    return spark.createDataFrame(rows, "label int, score double, pred int")


def test_metrics_zero_division(spark):
    df = frame(spark, [(1, 0.1, 0), (0, 0.2, 0)])
    m = mt.classification_metrics(df, "label", "pred").first()
    assert (m.precision, m.recall, m.f1, m.accuracy) == (0.0, 0.0, 0.0, 0.5)


@pytest.mark.parametrize("rows,auc", [
    ([(1, 0.9, 1), (1, 0.8, 1), (0, 0.1, 0), (0, 0.2, 0)], 1.0),
    ([(0, 0.9, 1), (0, 0.8, 1), (1, 0.1, 0), (1, 0.2, 0)], 0.0),
    ([(0, 0.5, 1), (1, 0.5, 1), (0, 0.5, 1), (1, 0.5, 1)], 0.5),
    ([(1, 0.5, 1), (1, 0.7, 1)], None),
])
def test_auc_cases(spark, rows, auc):
    assert mt.roc_auc(frame(spark, rows), "label", "score").first().auc == auc


def test_auc_matches_spark_evaluator(spark):
    df = spark.range(4000).select(
        (F.rand(3) < 0.3).cast("int").alias("label"),
        F.round(F.rand(5) + F.col("id") % 3 * 0.1, 2).alias("score"))
    df = df.withColumn("label", F.when(F.rand(9) < 0.6, F.col("label")).otherwise(
        (F.col("score") > 0.7).cast("int"))).cache()
    ours = mt.roc_auc(df, "label", "score", num_blocks=5).first().auc
    ev = BinaryClassificationEvaluator(rawPredictionCol="score", labelCol="label",
                                       metricName="areaUnderROC", numBins=0)
    assert ours == pytest.approx(ev.evaluate(df.withColumn("label", F.col("label").cast("double"))),
                                 abs=1e-12)


def test_roc_curve_ends(spark):
    df = frame(spark, [(1, 0.9, 1), (0, 0.8, 1), (1, 0.3, 0), (0, 0.1, 0)])
    pts = mt.roc_curve(df, "label", "score").orderBy(F.col("fpr"), F.col("tpr")).collect()
    assert (pts[0].tpr, pts[0].fpr) == (0.0, 0.0)
    assert (pts[-1].tpr, pts[-1].fpr) == (1.0, 1.0)
    assert len(pts) == 5


def test_scaler_stats(spark):
    df = spark.createDataFrame([(1.0,), (2.0,), (3.0,)], "x double")
    r = mt.scaler_stats(df, ["x"]).first()
    assert r.mean == 2.0 and r.std_pop == pytest.approx(math.sqrt(2 / 3)) and r.std_sample == 1.0
