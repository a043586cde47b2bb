"""Classification metrics, exact ROC AUC (ties count 1/2), ROC points and
feature scaling statistics -- all as distributed aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pitstop.operators.ranking import running_totals


def _ratio(num, den):
    return F.when(den == 0, F.lit(0.0)).otherwise(num.cast("double") / den.cast("double"))


def classification_metrics(df: DataFrame, label_col: str, pred_col: str) -> DataFrame:
    """One row: accuracy, precision, recall, f1 (positive class 1; a zero
    denominator gives 0) and the confusion counts."""
    y, p = F.col(label_col), F.col(pred_col)
    c = df.agg(F.count_if((y == 1) & (p == 1)).alias("tp"),
               F.count_if((y != 1) & (p == 1)).alias("fp"),
               F.count_if((y != 1) & (p != 1)).alias("tn"),
               F.count_if((y == 1) & (p != 1)).alias("fn"))
    tp, fp, tn, fn = (F.col(x) for x in ("tp", "fp", "tn", "fn"))
    return c.select(
        _ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"),
        _ratio(tp, tp + fp).alias("precision"),
        _ratio(tp, tp + fn).alias("recall"),
        _ratio(2 * tp, 2 * tp + fp + fn).alias("f1"),
        "tp", "fp", "tn", "fn")


def score_counts(df: DataFrame, label_col: str, score_col: str) -> DataFrame:
    """Distinct scores with positive / negative counts (partial aggregation
    folds repeated scores before the shuffle)."""
    y = F.col(label_col)
    return (df.where(F.col(score_col).isNotNull() & y.isNotNull())
            .groupBy(F.col(score_col).cast("double").alias("score"))
            .agg(F.count_if(y == 1).alias("pos"), F.count_if(y != 1).alias("neg")))


def roc_auc(df: DataFrame, label_col: str, score_col: str,
            num_blocks: int | None = None) -> DataFrame:
    """One row (auc, n_pos, n_neg): the rank-sum AUC with tied scores
    counted 1/2; NULL when a class is missing."""
    sc = score_counts(df, label_col, score_col)
    ranked = running_totals(sc, [], "score", ["neg"], ascending=True, num_blocks=num_blocks)
    tot = ranked.agg(
        F.sum(F.col("pos") * (F.col("neg_before") + F.col("neg") * 0.5)).alias("_w"),
        F.sum("pos").alias("n_pos"), F.sum("neg").alias("n_neg"))
    return tot.select(
        F.when((F.col("n_pos") > 0) & (F.col("n_neg") > 0),
               F.col("_w") / (F.col("n_pos").cast("double") * F.col("n_neg")))
        .alias("auc"),
        F.coalesce(F.col("n_pos"), F.lit(0)).cast("long").alias("n_pos"),
        F.coalesce(F.col("n_neg"), F.lit(0)).cast("long").alias("n_neg"))


def roc_curve(df: DataFrame, label_col: str, score_col: str,
              num_blocks: int | None = None) -> DataFrame:
    """ROC points, one per distinct score (threshold: score >= t) plus the
    origin (threshold NULL): (threshold, tp, fp, tpr, fpr)."""
    sc = score_counts(df, label_col, score_col)
    ranked = running_totals(sc, [], "score", ["pos", "neg"], ascending=False, num_blocks=num_blocks)
    pts = ranked.select(F.col("score").alias("threshold"),
                        (F.col("pos_before") + F.col("pos")).alias("tp"),
                        (F.col("neg_before") + F.col("neg")).alias("fp"),
                        F.coalesce("pos_all", F.lit(0)).alias("n_pos"), F.coalesce("neg_all", F.lit(0)).alias("n_neg"))
    origin = sc.sparkSession.range(1).selectExpr("CAST(NULL AS DOUBLE) AS threshold", "0L AS tp", "0L AS fp",
                                                 "0L AS n_pos", "0L AS n_neg")
    return pts.unionByName(origin).select(
        "threshold", F.col("tp").cast("long").alias("tp"), F.col("fp").cast("long").alias("fp"),
        _ratio(F.col("tp"), F.col("n_pos")).alias("tpr"), _ratio(F.col("fp"), F.col("n_neg")).alias("fpr"))


def scaler_stats(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """(feature, n, mean, std_pop, std_sample) in one aggregate pass."""
    aggs = []
    for i, f in enumerate(features):
        x = F.col(f).cast("double")
        aggs += [F.count(x).alias(f"n{i}"), F.avg(x).alias(f"m{i}"),
                 F.stddev_pop(x).alias(f"sp{i}"), F.stddev_samp(x).alias(f"ss{i}")]
    row = df.agg(*aggs)
    recs = [F.struct(F.lit(f).alias("feature"), F.col(f"n{i}").alias("n"),
                     F.col(f"m{i}").alias("mean"), F.col(f"sp{i}").alias("std_pop"),
                     F.col(f"ss{i}").alias("std_sample")) for i, f in enumerate(features)]
    return row.select(F.explode(F.array(*recs)).alias("r")).select("r.*")
