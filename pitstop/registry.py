"""Registry of the runnable queries: name -> (spark, sf_dir) -> DataFrame,
plus the DuckDB twin for the SQL-expressible ones.  Every query reads the
whole driver tables through :mod:`pitstop.sources.tables`."""

from __future__ import annotations

import datetime as dt
import functools
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.operators import boosting as bst
from pitstop.operators import drift, equivalence
from pitstop.operators import features as ft
from pitstop.operators import incremental
from pitstop.operators import logistic as lgs
from pitstop.operators import metrics as mt
from pitstop.operators import quality as dq
from pitstop.operators import rollup
from pitstop.operators import score as sc
from pitstop.operators import sketches
from pitstop.operators import train as trn
from pitstop.operators.split import stratified_split
from pitstop.operators.transform import training_rows, transform_features
from pitstop.plans import feature_sql as fsql
from pitstop.plans import model_oracles as mor
from pitstop.plans import oracles as orc
from pitstop.plans import stream_jobs
from pitstop.plans.scoring_job import requests_as_of
from pitstop.session import scratch_path
from pitstop.sources import datasets, dirty
from pitstop.sources import tables as tb
from pitstop.sources.readers import read_csv_table
from pitstop.sources.schemas import FEATURE_COLUMNS, LABEL_COLUMN, ORDERS
from pitstop.streaming import scoring as sscore
from pitstop.streaming.drift import windowed_psi_stream

# Fixed parameters of the registered queries.
CUTOFF = dt.date(1998, 1, 1)          # default cutoff
EARLY_CUTOFF = dt.date(1995, 3, 1)    # most customers still without orders
BACKTEST_CUTOFFS = [dt.date(1996, 1, 1), dt.date(1997, 1, 1), dt.date(1997, 7, 1),
                    dt.date(1998, 1, 1), dt.date(1998, 2, 15), dt.date(1999, 1, 1),
                    dt.date(2000, 1, 1)]
SAMPLE_MAX_CUSTOMER_ID = 500

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE_SQL: dict[str, str] = {}


def register(name: str, oracle: str | None = None):
    def deco(fn):
        @functools.wraps(fn)
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return fn(spark, sf_dir.rstrip("/"))
        QUERIES[name] = run
        if oracle is not None:
            ORACLE_SQL[name] = oracle
        return run
    return deco


def model(spark, sf_dir):
    return tb.customers(spark, sf_dir), tb.orders(spark, sf_dir), tb.order_items(spark, sf_dir)


# ---------------------------------------------------------------- features

@register("feature_table", orc.feature_table(CUTOFF))
def q_feature_table(spark, sf_dir):
    return ft.feature_table(*model(spark, sf_dir), CUTOFF)


@register("feature_table_early_cutoff", orc.feature_table(EARLY_CUTOFF))
def q_feature_table_early(spark, sf_dir):
    return ft.feature_table(*model(spark, sf_dir), EARLY_CUTOFF)


@register("feature_table_grouped", orc.feature_table(CUTOFF))
def q_feature_table_grouped(spark, sf_dir):
    return ft.feature_table_grouped(*model(spark, sf_dir), CUTOFF)


@register("feature_table_sql", orc.feature_table(CUTOFF))
def q_feature_table_sql(spark, sf_dir):
    return fsql.feature_table_sql(spark, sf_dir, CUTOFF)


@register("feature_table_correlated", orc.feature_table_correlated(CUTOFF))
def q_feature_table_correlated(spark, sf_dir):
    return fsql.feature_table_correlated(spark, sf_dir, CUTOFF)


@register("feature_table_lateral", orc.feature_table_correlated(CUTOFF))
def q_feature_table_lateral(spark, sf_dir):
    return fsql.feature_table_lateral(spark, sf_dir, CUTOFF)


@register("past_orders", orc.past_orders(CUTOFF))
def q_past_orders(spark, sf_dir):
    po = ft.past_orders(tb.orders(spark, sf_dir), CUTOFF)
    return po.withColumn("order_total", po.order_total.cast("double"))


@register("past_agg", orc.past_agg(CUTOFF))
def q_past_agg(spark, sf_dir):
    return ft.past_agg(tb.orders(spark, sf_dir), CUTOFF)


@register("past_products", orc.past_products(CUTOFF))
def q_past_products(spark, sf_dir):
    return ft.past_products(tb.orders(spark, sf_dir), tb.order_items(spark, sf_dir), CUTOFF)


@register("future_orders", orc.future_orders(CUTOFF))
def q_future_orders(spark, sf_dir):
    return ft.future_orders(tb.orders(spark, sf_dir), CUTOFF)


@register("churn_label", orc.churn_label(CUTOFF))
def q_churn_label(spark, sf_dir):
    return ft.feature_table(*model(spark, sf_dir), CUTOFF).select(
        "customer_id", "orders_next_90d", "churned")


@register("customer_sample_features", orc.customer_sample(CUTOFF, SAMPLE_MAX_CUSTOMER_ID))
def q_customer_sample(spark, sf_dir):
    return ft.customer_sample(ft.feature_table, *model(spark, sf_dir), CUTOFF,
                              SAMPLE_MAX_CUSTOMER_ID)


@register("multi_cutoff_features", orc.multi_cutoff(BACKTEST_CUTOFFS))
def q_multi_cutoff(spark, sf_dir):
    return ft.multi_cutoff_features(*model(spark, sf_dir), BACKTEST_CUTOFFS)


@register("approx_distinct_products", orc.approx_distinct_products(BACKTEST_CUTOFFS))
def q_approx_distinct_products(spark, sf_dir):
    """Distinct products by country and cutoff from merged sketches, beside the
    exact counts; the relative error stays within four standard errors."""
    c, o, i = model(spark, sf_dir)
    placed = o.join(c.select("customer_id", "country"), "customer_id")
    guess = sketches.approx_past_products(placed, i, BACKTEST_CUTOFFS, ["country"])
    first = ft.first_purchases(placed, i, BACKTEST_CUTOFFS, ["country"])
    exact = (first.groupBy("country").agg(*[F.count_if(F.col("idx") <= k).alias(f"n{k}") for k in range(len(BACKTEST_CUTOFFS))])
        .select("country", F.explode(F.array(*[F.struct(F.lit(d).alias("cutoff_date"), F.col(f"n{k}").alias("exact"))
                                               for k, d in enumerate(BACKTEST_CUTOFFS)])).alias("r")).select("country", "r.*"))
    error = F.abs(F.col("distinct_products") - F.col("exact")) / F.col("exact")
    return guess.join(exact, ["country", "cutoff_date"]).select(
        "cutoff_date", "country", "exact", (error <= 4 * sketches.relative_error()).alias("within_bound"))


@register("approx_customer_products", orc.approx_customer_products(BACKTEST_CUTOFFS))
def q_approx_customer_products(spark, sf_dir):
    """Distinct products by customer and cutoff from merged sketches: counts as
    small as these are exact."""
    _, o, i = model(spark, sf_dir)
    return sketches.approx_past_products(o, i, BACKTEST_CUTOFFS)


@register("form_equivalence", orc.form_equivalence())
def q_form_equivalence(spark, sf_dir):
    """Fused, grouped and SQL feature tables against one another: buckets that differ."""
    fused = staged(features_at(spark, sf_dir), "form-fused")
    grouped = staged(ft.feature_table_grouped(*model(spark, sf_dir), CUTOFF), "form-grouped")
    text = staged(fsql.feature_table_sql(spark, sf_dir, CUTOFF), "form-sql")
    zero = F.lit(0).cast("long")

    def pair(name, other):
        differing = equivalence.differing_buckets(fused, other).select(F.lit(name).alias("form"), F.lit(1).cast("long").alias("d"), zero.alias("n"))
        return differing.unionAll(other.select(F.lit(name), zero, F.lit(1).cast("long")))
    return (pair("grouped", grouped).unionAll(pair("sql", text)).groupBy("form")
            .agg(F.sum("d").alias("differing"), F.sum("n").alias("n_rows")))


@register("form_difference", orc.form_difference(CUTOFF))
def q_form_difference(spark, sf_dir):
    """The feature table against one with planted differences: changed, missing and repeated rows."""
    sound = staged(features_at(spark, sf_dir), "form-sound")
    planted = sound.where("customer_id % 211 <> 3").selectExpr(
        *[c for c in sound.columns if c != "total_spend"],
        "CASE WHEN customer_id % 157 = 5 THEN total_spend + 0.01D ELSE total_spend END AS total_spend")
    planted = planted.unionByName(planted.where("customer_id % 307 = 9"))
    return equivalence.difference(sound, planted).select("customer_id", "total_spend", "n_left", "n_right")


# ------------------------------------------------- transform, quality, dq


def features_at(spark, sf_dir, cutoff=CUTOFF):
    return ft.feature_table(*model(spark, sf_dir), cutoff)


@register("transform_features", orc.transform_features(CUTOFF))
def q_transform_features(spark, sf_dir):
    return transform_features(features_at(spark, sf_dir))


@register("training_rows", orc.training_rows(CUTOFF))
def q_training_rows(spark, sf_dir):
    return training_rows(features_at(spark, sf_dir))


@register("validate_report", orc.validate_report(CUTOFF))
def q_validate_report(spark, sf_dir):
    return dq.validate_report(transform_features(features_at(spark, sf_dir)))


@register("validate_report_backtest", orc.validate_report_backtest(BACKTEST_CUTOFFS))
def q_validate_report_backtest(spark, sf_dir):
    return dq.validate_report(ft.multi_cutoff_features(*model(spark, sf_dir), BACKTEST_CUTOFFS))


@register("label_rate", orc.label_rate(CUTOFF))
def q_label_rate(spark, sf_dir):
    return features_at(spark, sf_dir).agg(
        F.count(F.lit(1)).alias("n_rows"), F.round(F.avg("churned"), 9).alias("churn_rate"))


@register("dq_null_rates", orc.dq_null_rates())
def q_dq_null_rates(spark, sf_dir):
    return dq.union_all([
        dq.null_rates(tb.customers(spark, sf_dir), "customers"),
        dq.null_rates(tb.orders(spark, sf_dir), "orders"),
        dq.null_rates(tb.order_items(spark, sf_dir), "order_items"),
        dq.null_rates(tb.products(spark, sf_dir), "products"),
    ])


@register("dq_duplicates", orc.dq_duplicates())
def q_dq_duplicates(spark, sf_dir):
    return dq.duplicate_keys(tb.order_items(spark, sf_dir), ["order_id", "product_id"])


@register("dedup_order_items", orc.dedup_order_items())
def q_dedup_order_items(spark, sf_dir):
    return dq.dedup_keep_lowest(tb.order_items(spark, sf_dir), ["order_id", "product_id"],
                                "order_item_id")


@register("dq_fk_orphans", orc.dq_fk_orphans())
def q_dq_fk_orphans(spark, sf_dir):
    c, o, i, p = (tb.customers(spark, sf_dir), tb.orders(spark, sf_dir),
                  tb.order_items(spark, sf_dir), tb.products(spark, sf_dir))
    return dq.union_all([
        dq.fk_orphans(o, "customer_id", c, "customer_id", "orders.customer_id -> customers"),
        dq.fk_orphans(i, "order_id", o, "order_id", "order_items.order_id -> orders"),
        dq.fk_orphans(i, "product_id", p, "product_id", "order_items.product_id -> products"),
    ])


@register("item_price_lookup", orc.item_price_lookup())
def q_item_price_lookup(spark, sf_dir):
    df = rollup.item_price_lookup(tb.order_items(spark, sf_dir), tb.products(spark, sf_dir))
    return df.withColumn("unit_price", F.col("unit_price").cast("double"))


@register("order_total_rollup", orc.order_total_rollup())
def q_order_total_rollup(spark, sf_dir):
    priced = rollup.item_price_lookup(tb.order_items(spark, sf_dir), tb.products(spark, sf_dir))
    return rollup.order_total_rollup(tb.orders(spark, sf_dir), priced)


# ------------------------------------------------------------------- drift


DRIFT_EXPECTED_CUTOFF = dt.date(1997, 1, 1)
EDGE_DIGITS = 6   # oracle pairs round edges on both sides (ulp-sensitive)


def drift_sides(spark, sf_dir):
    """Transformed features at the two cutoffs, computed in ONE pass over the
    orders (multi-cutoff plan) and published by cutoff; each side reads its
    own partition and only the columns it needs."""
    path = scratch_path(spark, "drift-sides")
    both = transform_features(ft.multi_cutoff_features(*model(spark, sf_dir), [DRIFT_EXPECTED_CUTOFF, CUTOFF]))
    datasets.write_dataset(both, path)
    side = lambda d: datasets.read_dataset(spark, path, d, both.schema).drop("cutoff_date")
    return side(DRIFT_EXPECTED_CUTOFF), side(CUTOFF)


@register("psi_edges", orc.psi_edges(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_psi_edges(spark, sf_dir):
    e, _ = drift_sides(spark, sf_dir)
    return (drift.edges_table(e, FEATURE_COLUMNS, edge_digits=EDGE_DIGITS)
            .select("feature", F.posexplode("edges").alias("edge_idx", "edge"))
            .withColumn("edge_idx", F.col("edge_idx").cast("long")))


@register("psi_histogram", orc.psi_histogram(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_psi_histogram(spark, sf_dir):
    e, a = drift_sides(spark, sf_dir)
    return drift.psi_histogram(e, a, FEATURE_COLUMNS, edge_digits=EDGE_DIGITS)


@register("psi_report", orc.psi_report(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_psi_report(spark, sf_dir):
    e, a = drift_sides(spark, sf_dir)
    rep = drift.psi_report(e, a, FEATURE_COLUMNS, edge_digits=EDGE_DIGITS)
    return (rep.withColumn("psi", F.round("psi", 9))
            .withColumn("verdict", drift.psi_verdict(F.col("psi"))))


@register("psi_report_common_features", orc.psi_report_common_features(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_psi_report_common_features(spark, sf_dir):
    """Each side lacks a feature: the report has those that both have."""
    e, a = drift_sides(spark, sf_dir)
    rep = drift.psi_report(e.drop("tenure_days"), a.drop("total_spend"), FEATURE_COLUMNS, edge_digits=EDGE_DIGITS)
    return rep.withColumn("psi", F.round("psi", 9)).withColumn("verdict", drift.psi_verdict(F.col("psi")))


def events_long(spark, sf_dir):
    ev = tb.raw(spark, sf_dir, "events")
    # date_trunc returns a zoned TIMESTAMP; back to NTZ (session zone is UTC)
    return ev.select("event_type", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("window_start"),
                     "value")


@register("windowed_psi", orc.windowed_psi())
def q_windowed_psi(spark, sf_dir):
    ev = events_long(spark, sf_dir)
    profile = drift.expected_profile(ev, "event_type", "value", edge_digits=EDGE_DIGITS)
    out = drift.grouped_psi(ev, profile, "event_type", "value", by=["window_start"])
    return (out.withColumn("psi", F.round("psi", 9))
            .withColumn("verdict", drift.psi_verdict(F.col("psi")))
            .select("event_type", "window_start", "n_actual", "n_out_of_range", "psi", "verdict"))


@register("grouped_psi_unseen", orc.grouped_psi_unseen())
def q_grouped_psi_unseen(spark, sf_dir):
    """Integer groups, NULL among them, some of which one side does not have."""
    ev = tb.raw(spark, sf_dir, "events")
    old = ev.select(F.expr("CASE WHEN user_id % 13 < 8 THEN CAST(user_id % 13 AS INT) END").alias("grp"), "value")
    new = ev.select(F.expr("CASE WHEN user_id % 17 < 12 THEN CAST(user_id % 17 AS INT) END").alias("grp"), "value")
    profile = drift.expected_profile(old, "grp", "value", edge_digits=EDGE_DIGITS)
    out = drift.grouped_psi(new, profile, "grp", "value").withColumn("psi", F.round("psi", 9))
    return out.withColumn("verdict", drift.psi_verdict(F.col("psi")))


SKETCH_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 20))
RANK_ERROR, PSI_ERROR = 0.02, 0.02


@register("sketched_profile", orc.sketched_profile(*SKETCH_DAYS))
def q_sketched_profile(spark, sf_dir):
    """Quantiles of a range of days from merged day sketches: how far the exact
    rank of each is from the rank asked for."""
    ev = tb.raw(spark, sf_dir, "events")
    days = staged(sketches.daily_sketches(ev, "event_type", "value", "ts"), "day-sketches")
    probs = drift.quantile_probs()
    merged = sketches.range_sketches(days, "event_type", *SKETCH_DAYS).select(
        "event_type", "n", sketches.sketch_quantiles("sketch", probs).alias("q"))
    inside = ev.where(F.to_date("ts").between(*map(F.lit, SKETCH_DAYS)) & F.col("value").isNotNull() & ~F.isnan("value"))
    ranks = inside.join(merged, "event_type").groupBy("event_type").agg(
        F.count(F.lit(1)).alias("n_exact"), F.max("n").alias("n"),
        *[F.expr(f"count_if(value < q[{k}])").alias(f"lo{k}") for k in range(len(probs))],
        *[F.expr(f"count_if(value <= q[{k}])").alias(f"hi{k}") for k in range(len(probs))])
    each = F.array(*[F.struct(F.lit(k).cast("long").alias("q_idx"), (
        F.greatest(F.lit(p) - F.col(f"hi{k}") / F.col("n_exact"), F.col(f"lo{k}") / F.col("n_exact") - F.lit(p)) <= RANK_ERROR
    ).alias("within_bound")) for k, p in enumerate(probs)])
    return ranks.select("event_type", "n", F.explode(each).alias("r")).select("event_type", "n", "r.*")


@register("sketched_psi", orc.sketched_psi(*SKETCH_DAYS))
def q_sketched_psi(spark, sf_dir):
    """PSI of the later days against the sketched profile of the earlier ones,
    beside the exact one."""
    ev = tb.raw(spark, sf_dir, "events")
    days = staged(sketches.daily_sketches(ev, "event_type", "value", "ts"), "day-sketches")
    early = F.to_date("ts").between(*map(F.lit, SKETCH_DAYS))
    live = ev.where(F.to_date("ts") > F.lit(SKETCH_DAYS[1]))
    exact = drift.grouped_psi(live, drift.expected_profile(ev.where(early), "event_type", "value"), "event_type", "value")
    profile = staged(sketches.sketch_profile(days, "event_type", *SKETCH_DAYS), "sketch-profile")
    close = drift.grouped_psi(live, profile, "event_type", "value").select("event_type", F.col("psi").alias("sketched"))
    return exact.join(close, "event_type").select(
        "event_type", "n_actual", (F.abs(F.col("psi") - F.col("sketched")) <= PSI_ERROR).alias("within_bound"))


# ------------------------------------------------------ split and metrics


SPLIT_SEED = 42
TEST_FRACTION = 0.2


def fixed_score(df):
    """A fixed-formula churn score (for metric checks without a model)."""
    return (F.lit(0.7) * (F.col("recency_days").cast("double") / F.lit(730.0))
            + F.lit(0.3) / (F.lit(1) + F.col("order_count")).cast("double"))


def scored_rows(spark, sf_dir):
    t = transform_features(features_at(spark, sf_dir))
    return t.select("customer_id", "churned", fixed_score(t).alias("score"))


@register("stratified_split", orc.stratified_split(CUTOFF, TEST_FRACTION, SPLIT_SEED))
def q_stratified_split(spark, sf_dir):
    # the split reads its input three times (counts, cuts, rows): compute it once
    rows = staged(training_rows(features_at(spark, sf_dir)), "split-input")
    return stratified_split(rows, "churned", "customer_id", TEST_FRACTION, SPLIT_SEED).select(
        "customer_id", "churned", "is_test")


@register("classification_metrics", orc.classification_metrics(CUTOFF))
def q_classification_metrics(spark, sf_dir):
    s = scored_rows(spark, sf_dir).withColumn("pred", (F.col("score") >= 0.5).cast("int"))
    m = mt.classification_metrics(s, "churned", "pred")
    return m.select(*[F.round(c, 9).alias(c) for c in ("accuracy", "precision", "recall", "f1")],
                    "tp", "fp", "tn", "fn")


@register("roc_auc", orc.roc_auc(CUTOFF))
def q_roc_auc(spark, sf_dir):
    r = mt.roc_auc(scored_rows(spark, sf_dir), "churned", "score")
    return r.select(F.round("auc", 9).alias("auc"), "n_pos", "n_neg")


@register("roc_curve", orc.roc_curve(CUTOFF))
def q_roc_curve(spark, sf_dir):
    r = mt.roc_curve(scored_rows(spark, sf_dir), "churned", "score")
    return r.select("threshold", "tp", "fp", F.round("tpr", 9).alias("tpr"),
                    F.round("fpr", 9).alias("fpr"))


@register("scaler_stats", orc.scaler_stats(CUTOFF))
def q_scaler_stats(spark, sf_dir):
    s = mt.scaler_stats(training_rows(features_at(spark, sf_dir)), FEATURE_COLUMNS)
    # moments of ~1e6-sized spends differ at ulp level with summation order:
    # 6 decimals (about 1e-12 relative) on both sides
    return s.select("feature", "n", *[F.round(c, 6).alias(c) for c in ("mean", "std_pop", "std_sample")])


@register("fitted_scaler", orc.fitted_scaler(CUTOFF))
def q_fitted_scaler(spark, sf_dir):
    """Means and deviations that the fitted baseline pipeline scales by."""
    rows = staged(training_rows(features_at(spark, sf_dir)), "scaler-rows")
    scaler = next(s for s in trn.fit(trn.BASELINE, rows).model.stages if hasattr(s, "std"))
    return spark.createDataFrame([(f, float(m), float(d)) for f, m, d in zip(FEATURE_COLUMNS, scaler.mean, scaler.std)],
                                 "feature string, mean double, std double").select(
        "feature", F.round("mean", 6).alias("mean"), F.round("std", 6).alias("std"))


# ---------------------------------------------------------------- scoring


def requests(spark, sf_dir):
    return requests_as_of(*model(spark, sf_dir), CUTOFF)


@register("score_inputs", orc.score_inputs(CUTOFF))
def q_score_inputs(spark, sf_dir):
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    filled = sc.fill_defaults(accepted)
    return filled.select("customer_id", *FEATURE_COLUMNS,
                         F.array_join("used_defaults_for", ",").alias("used_defaults"))


@register("score_rejects", orc.score_rejects(CUTOFF))
def q_score_rejects(spark, sf_dir):
    _, rejected = sc.split_requests(requests(spark, sf_dir))
    return rejected.select("customer_id", *FEATURE_COLUMNS, "reject_reason")


def staged(df, name):
    """``df`` written to the shared folder and read back: computed once, columns pruned."""
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def split_rows(spark, sf_dir):
    rows = staged(training_rows(features_at(spark, sf_dir)), "split-input")
    return stratified_split(rows, LABEL_COLUMN, "customer_id", TEST_FRACTION, SPLIT_SEED)


@register("model_metrics")
def q_model_metrics(spark, sf_dir):
    """End to end: publish the dataset at the cutoff, train both reference
    models (reference parameters) from that partition, evaluate on the
    test split; one row per (model, metric)."""
    from pitstop.plans.dataset_job import build_dataset
    from pitstop.plans.training_job import train_from_dataset
    path = scratch_path(spark, "features")
    build_dataset(spark, sf_dir, CUTOFF, path)
    best, models, _ = train_from_dataset(spark, path, CUTOFF, model_path=scratch_path(spark, "model"))
    recs = [(m.name, k, None if v is None else float(v), m.name == best.name)
            for m in models for k, v in m.metrics.items()]
    return spark.createDataFrame(recs, "model string, metric string, value double, selected boolean")


@register("batch_scores")
def q_batch_scores(spark, sf_dir):
    """Baseline model fitted on the train split scores every accepted
    request as of the cutoff."""
    sp = staged(split_rows(spark, sf_dir), "split")
    m = trn.fit(trn.BASELINE, sp.where(~F.col("is_test")).drop("is_test"))
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    return sc.score(accepted, m.model, "fitted:" + trn.BASELINE).select(
        "customer_id", *FEATURE_COLUMNS, "churn_probability", "churn_prediction", "model_source",
        F.array_join("used_defaults_for", ",").alias("used_defaults"))


# ------------------------------------------- models that are fitted here


BOOST = dict(trees=6, depth=bst.DEPTH, rate=bst.RATE, max_bins=bst.MAX_BINS)


def split_parts(spark, sf_dir):
    sp = staged(split_rows(spark, sf_dir), "split")
    return sp.where(~F.col("is_test")).drop("is_test"), sp.where("is_test").drop("is_test")


def test_metrics(test, score):
    """metric, value of a score (rounded to 9 digits) on the test rows."""
    scored = staged(test.select(LABEL_COLUMN, F.round(score, 9).alias("score")), "scored")
    pred = scored.withColumn("pred", sc.threshold(F.col("score")))
    names = ("accuracy", "precision", "recall", "f1")
    one = mt.classification_metrics(pred, LABEL_COLUMN, "pred").select(
        F.explode(F.array(*[F.struct(F.lit(m).alias("metric"), F.round(m, 9).alias("value")) for m in names])).alias("r")).select("r.*")
    return one.unionAll(mt.roc_auc(scored, LABEL_COLUMN, "score").select(F.lit("roc_auc"), F.round("auc", 9)))


@register("logistic_weights", mor.logistic_weights(CUTOFF))
def q_logistic_weights(spark, sf_dir):
    """Newton's optimum on the train split, and the size of the gradient there."""
    train, _ = split_parts(spark, sf_dir)
    return lgs.fit_logistic(train).table(spark).select(
        "term", F.round("weight", 6).alias("weight"), F.round(F.abs("gradient"), 6).alias("gradient_size"))


@register("logistic_metrics", mor.logistic_metrics(CUTOFF))
def q_logistic_metrics(spark, sf_dir):
    """Fit on the train split, evaluate on the test split."""
    train, test = split_parts(spark, sf_dir)
    return test_metrics(test, lgs.fit_logistic(train).score())


@register("batch_scores_logistic", mor.batch_scores_logistic(CUTOFF))
def q_batch_scores_logistic(spark, sf_dir):
    """Accepted requests as of the cutoff, scored by the fitted weights."""
    train, _ = split_parts(spark, sf_dir)
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    return sc.score_by(accepted, lgs.fit_logistic(train).score(), "fitted:newton").select(
        "customer_id", *FEATURE_COLUMNS, "churn_probability", "churn_prediction", "model_source",
        F.array_join("used_defaults_for", ",").alias("used_defaults"))


@register("boosted_trees", mor.boosted_trees(CUTOFF, unit=bst.UNIT, **BOOST))
def q_boosted_trees(spark, sf_dir):
    """Splits and leaves of the first trees, learned from the train split."""
    train, _ = split_parts(spark, sf_dir)
    return (bst.fit_boosted(train, edge_digits=EDGE_DIGITS, **BOOST).table(spark)
            .withColumn("weight", F.round("weight", 6)))


@register("boosted_metrics", mor.boosted_metrics(CUTOFF, unit=bst.UNIT, **BOOST))
def q_boosted_metrics(spark, sf_dir):
    """The same trees, evaluated on the test split."""
    train, test = split_parts(spark, sf_dir)
    return test_metrics(test, bst.fit_boosted(train, edge_digits=EDGE_DIGITS, **BOOST).score())


def both_models(spark, sf_dir):
    """Newton's logistic regression and the boosted trees, with their metrics on the test split."""
    train, test = split_parts(spark, sf_dir)
    scores = ((trn.BASELINE, trn.BASELINE_PARAMS, lgs.fit_logistic(train).score()),
              (trn.BOOSTED, BOOST, bst.fit_boosted(train, edge_digits=EDGE_DIGITS, **BOOST).score()))
    return [trn.TrainedModel(name, None, dict(params), {r["metric"]: r["value"] for r in test_metrics(test, score).collect()})   # five rows
            for name, params, score in scores]


@register("model_choice", mor.model_choice(CUTOFF, unit=bst.UNIT, **BOOST))
def q_model_choice(spark, sf_dir):
    """Both models' metrics and which one is chosen: by AUC, on a tie the boosted one."""
    models = both_models(spark, sf_dir)
    best = trn.select_best(models)
    return spark.createDataFrame([(m.name, k, v, m.name == best.name) for m in models for k, v in m.metrics.items()],
                                 "model string, metric string, value double, selected boolean")


@register("run_records", mor.run_records(CUTOFF, trn.BASELINE_PARAMS, BOOST, unit=bst.UNIT, **BOOST))
def q_run_records(spark, sf_dir):
    """The run's metrics and parameters as they are read back from the appended records."""
    models, path = both_models(spark, sf_dir), scratch_path(spark, "runs")
    trn.log_runs(spark, trn.run_records(models, trn.select_best(models), CUTOFF), path)
    return spark.read.parquet(path).select("model", "kind", "name", "value", "selected", "cutoff_date")


@register("batch_scores_saved_model", mor.batch_scores_logistic(CUTOFF, "fallback"))
def q_batch_scores_saved_model(spark, sf_dir):
    """Spark's own regression, fitted to its limit, saved, loaded from the
    second of two paths and applied: it scores as Newton's optimum does."""
    from pitstop.sources.model_store import load_model, save_model
    train, _ = split_parts(spark, sf_dir)
    fitted = trn.fit(trn.BASELINE, train, baseline_params={**trn.BASELINE_PARAMS, "tol": 1e-13})
    path = save_model(fitted.model, scratch_path(spark, "model"))
    loaded, source = load_model([scratch_path(spark, "no-model"), path])
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    return sc.score(accepted, loaded, source.split(":")[0]).select(
        "customer_id", *FEATURE_COLUMNS, "churn_probability", "churn_prediction", "model_source",
        F.array_join("used_defaults_for", ",").alias("used_defaults"))


# -------------------------------------------------------------- streaming


@register("windowed_psi_stream", orc.windowed_psi())
def q_windowed_psi_stream(spark, sf_dir):
    ev = tb.raw(spark, sf_dir, "events")
    out = stream_jobs.run_windowed_drift(spark, ev, "event_type", "value", "ts",
                                         edge_digits=EDGE_DIGITS)
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      "n_actual", "n_out_of_range", F.round("psi", 9).alias("psi"),
                      drift.psi_verdict(F.round("psi", 9)).alias("verdict"))


SLIDE_WINDOW, SLIDE_STEP = "7 days", "1 day"


def sliding(out):
    return out.select("event_type", F.col("window_start").cast("timestamp_ntz").alias("window_start"),
                      F.col("window_end").cast("timestamp_ntz").alias("window_end"), "n_actual", "n_out_of_range",
                      F.round("psi", 9).alias("psi"), drift.psi_verdict(F.round("psi", 9)).alias("verdict"))


@register("sliding_psi", orc.sliding_psi())
def q_sliding_psi(spark, sf_dir):
    """Seven-day windows that start every day, from shared day panes, in batch."""
    ev = tb.raw(spark, sf_dir, "events")
    profile = drift.expected_profile(ev, "event_type", "value", edge_digits=EDGE_DIGITS)
    return sliding(windowed_psi_stream(ev, profile, "event_type", "value", "ts", SLIDE_WINDOW, SLIDE_STEP))


@register("sliding_psi_stream", orc.sliding_psi())
def q_sliding_psi_stream(spark, sf_dir):
    """The same through the stream: panes and windows are two watermarked states."""
    return sliding(stream_jobs.run_windowed_drift(spark, tb.raw(spark, sf_dir, "events"), "event_type", "value", "ts",
                                                  SLIDE_WINDOW, slide=SLIDE_STEP, edge_digits=EDGE_DIGITS))


@register("streaming_scores")
def q_streaming_scores(spark, sf_dir):
    """Requests as of the cutoff, scored as a file stream by the baseline
    model; returns the committed prediction log."""
    sp = staged(split_rows(spark, sf_dir), "split")
    m = trn.fit(trn.BASELINE, sp.where(~F.col("is_test")).drop("is_test"))
    log, _ = stream_jobs.run_streaming_scoring(spark, requests(spark, sf_dir), sscore.model_scorer(m.model, "fitted:" + trn.BASELINE))
    return log


@register("streaming_scores_logistic", mor.streaming_scores_logistic(CUTOFF))
def q_streaming_scores_logistic(spark, sf_dir):
    """The log of the stream, scored by the weights of Newton's optimum."""
    train, _ = split_parts(spark, sf_dir)
    log, _ = stream_jobs.run_streaming_scoring(spark, requests(spark, sf_dir),
                                               sscore.column_scorer(lgs.fit_logistic(train).score(), "fitted:newton"))
    return log.select("customer_id", *FEATURE_COLUMNS, F.round("churn_probability", 9).alias("churn_probability"))


@register("streaming_rejects", orc.dirty_score_rejects(CUTOFF))
def q_streaming_rejects(spark, sf_dir):
    """The quarantine of the same stream over dirty requests: the batch rule's rows."""
    _, rejects = stream_jobs.run_streaming_scoring(spark, dirty_requests(spark, sf_dir), sscore.column_scorer(fixed_formula(), "formula"))
    return rejects.select("customer_id", *FEATURE_COLUMNS, "reject_reason")


# ------------------------------------------------------- end-to-end jobs

@register("published_dataset", orc.published_dataset(CUTOFF))
def q_published_dataset(spark, sf_dir):
    """Extract -> transform -> validate -> publish one cutoff, read back."""
    from pitstop.plans.dataset_job import build_dataset
    path = scratch_path(spark, "features")
    build_dataset(spark, sf_dir, CUTOFF, path)
    return datasets.read_dataset(spark, path, CUTOFF)


@register("log_drift_report", orc.log_drift_report(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_log_drift_report(spark, sf_dir):
    """Publish the training dataset (earlier cutoff), fit the baseline on it,
    stream-score the requests of the later cutoff into the prediction log,
    then PSI of the logged inputs against the dataset partition."""
    from pitstop.plans.dataset_job import build_dataset
    from pitstop.plans.drift_job import log_drift
    from pitstop.plans.training_job import train_from_dataset
    path = scratch_path(spark, "features")
    build_dataset(spark, sf_dir, DRIFT_EXPECTED_CUTOFF, path)
    best, _, _ = train_from_dataset(spark, path, DRIFT_EXPECTED_CUTOFF, names=(trn.BASELINE,))
    log, _ = stream_jobs.run_streaming_scoring(spark, requests(spark, sf_dir), sscore.model_scorer(best.model, "fitted:" + trn.BASELINE))
    rep = log_drift(spark, path, DRIFT_EXPECTED_CUTOFF, log, edge_digits=EDGE_DIGITS)
    return (rep.withColumn("psi", F.round("psi", 9))
            .withColumn("verdict", drift.psi_verdict(F.col("psi"))))


@register("published_backtest", orc.published_backtest(BACKTEST_CUTOFFS))
def q_published_backtest(spark, sf_dir):
    """Many cutoffs at once: transform, validate on (cutoff, customer), publish, read back."""
    rows = transform_features(ft.multi_cutoff_features(*model(spark, sf_dir), BACKTEST_CUTOFFS))
    path = scratch_path(spark, "backtest")
    datasets.write_dataset(rows, path)
    back = datasets.read_dataset(spark, path, schema=rows.schema)
    dq.validate(back, key=["cutoff_date", "customer_id"])
    return back


@register("log_windowed_psi", orc.log_windowed_psi(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_log_windowed_psi(spark, sf_dir):
    """Drift per week of signup and feature of logged inputs against a published dataset."""
    return log_windowed(spark, sf_dir, streaming=False)


@register("log_windowed_psi_stream", orc.log_windowed_psi(DRIFT_EXPECTED_CUTOFF, CUTOFF))
def q_log_windowed_psi_stream(spark, sf_dir):
    return log_windowed(spark, sf_dir, streaming=True)


def log_windowed(spark, sf_dir, streaming):
    from pitstop.plans.drift_job import log_windowed_drift
    path, log = scratch_path(spark, "features"), scratch_path(spark, "log")
    datasets.write_dataset(transform_features(features_at(spark, sf_dir, DRIFT_EXPECTED_CUTOFF)), path, DRIFT_EXPECTED_CUTOFF)
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    # The log's times follow the customer's key, a day for every 150 customers.
    logged = sc.score_by(accepted, fixed_formula(), "formula").selectExpr(
        *FEATURE_COLUMNS, "churn_score AS churn_probability",
        "TIMESTAMP '2024-01-01 00:00:00' + make_dt_interval(CAST(customer_id DIV 150 AS INT)) AS logged_at")
    datasets.append_log(logged, log)
    out = log_windowed_drift(spark, path, DRIFT_EXPECTED_CUTOFF, log, window="7 days", edge_digits=EDGE_DIGITS, streaming=streaming)
    return (out.select("feature", F.col("window_start").cast("timestamp_ntz").alias("window_start"), "n_actual", "n_out_of_range",
                       F.round("psi", 9).alias("psi"))
            .withColumn("verdict", drift.psi_verdict(F.col("psi"))))


INCREMENTS = [dt.date(1996, 1, 1), dt.date(1997, 1, 1), CUTOFF]


@register("incremental_backtest", orc.incremental_backtest(INCREMENTS))
def q_incremental_backtest(spark, sf_dir):
    """Three cutoffs folded one after another, late orders among what arrives,
    then the features of the last two from the state.  An order arrives with
    the first increment that its date, or (every 17th) the next later one,
    falls to; the last one brings the rest."""
    c, o, i = model(spark, sf_dir)
    path, previous = scratch_path(spark, "increments"), None
    due = F.expr("CASE " + " ".join(f"WHEN order_date <= {ft.ts_sql(d)} THEN {k}" for k, d in enumerate(INCREMENTS)) + f" ELSE {len(INCREMENTS)} END")
    arrival = F.least(due + (F.col("order_id") % 17 == 0).cast("int"), F.lit(len(INCREMENTS) - 1))
    for k, cutoff in enumerate(INCREMENTS):
        feed = o.where(arrival == k)
        incremental.fold(spark, path, previous, cutoff, feed, i.join(feed.select("order_id"), "order_id", "left_semi"))
        previous = cutoff
    return incremental.features_from_state(spark, path, INCREMENTS[1], c).unionByName(
        incremental.features_from_state(spark, path, INCREMENTS[2], c))


def fixed_formula():
    return (F.pmod(F.col("recency_days") * 7 + F.col("order_count"), F.lit(1300)) / 900.0 - 0.1)


@register("batch_scores_formula", orc.batch_scores_formula(CUTOFF))
def q_batch_scores_formula(spark, sf_dir):
    """The scoring path (defaults, clamp, rounding, threshold) on a fixed score."""
    accepted, _ = sc.split_requests(requests(spark, sf_dir))
    return sc.score_by(accepted, fixed_formula(), "formula").select(
        "customer_id", *FEATURE_COLUMNS, "churn_probability", "churn_prediction", "model_source",
        F.array_join("used_defaults_for", ",").alias("used_defaults"))


# ------------------------------------------------------------ dirty inputs

def dirty_model(spark, sf_dir):
    return dirty.customers(spark, sf_dir), dirty.orders(spark, sf_dir), dirty.order_items(spark, sf_dir)


def dirty_features(spark, sf_dir):
    return ft.feature_table(*dirty_model(spark, sf_dir), CUTOFF)


@register("dirty_feature_table", orc.dirty(orc.feature_table(CUTOFF)))
def q_dirty_feature_table(spark, sf_dir):
    return dirty_features(spark, sf_dir)


@register("dirty_feature_table_correlated", orc.dirty(orc.feature_table_correlated(CUTOFF)))
def q_dirty_feature_table_correlated(spark, sf_dir):
    """Five scalar subqueries a customer: repeated customers, and such whose
    subqueries find nothing.  The customers are a written table: Spark 4.1's
    optimizer fails on scalar subqueries over a UNION."""
    c, o, i = dirty_model(spark, sf_dir)
    return fsql.feature_sql_on(fsql.CORRELATED_SQL, staged(c, "dirty-customers"), o, i, CUTOFF)


@register("dirty_multi_cutoff", orc.dirty(orc.multi_cutoff(BACKTEST_CUTOFFS)))
def q_dirty_multi_cutoff(spark, sf_dir):
    return ft.multi_cutoff_features(*dirty_model(spark, sf_dir), BACKTEST_CUTOFFS)


@register("dirty_transform_features", orc.dirty(orc.transform_features(CUTOFF)))
def q_dirty_transform_features(spark, sf_dir):
    return transform_features(dirty_features(spark, sf_dir))


@register("dirty_training_rows", orc.dirty(orc.training_rows(CUTOFF)))
def q_dirty_training_rows(spark, sf_dir):
    return training_rows(dirty_features(spark, sf_dir))


@register("dirty_validate_report", orc.dirty_validate_report(CUTOFF))
def q_dirty_validate_report(spark, sf_dir):
    """Every check finds something: repeated keys, negative counts and spends,
    labels beyond 0 and 1, tenures missing."""
    return dq.validate_report(dirty_features(spark, sf_dir).selectExpr(
        "customer_id", "CASE WHEN customer_id % 61 = 0 THEN -1 ELSE order_count END AS order_count", "total_spend",
        "distinct_products", "recency_days", "tenure_days", "CASE WHEN customer_id % 83 = 0 THEN 2 ELSE churned END AS churned"))


@register("dirty_null_rates", orc.dirty(orc.dq_null_rates()))
def q_dirty_null_rates(spark, sf_dir):
    c, o, i = dirty_model(spark, sf_dir)
    return dq.union_all([dq.null_rates(c, "customers"), dq.null_rates(o, "orders"), dq.null_rates(i, "order_items"),
                         dq.null_rates(tb.products(spark, sf_dir), "products")])


@register("dirty_fk_orphans", orc.dirty(orc.dq_fk_orphans()))
def q_dirty_fk_orphans(spark, sf_dir):
    c, o, i = dirty_model(spark, sf_dir)
    p = tb.products(spark, sf_dir)
    return dq.union_all([
        dq.fk_orphans(o, "customer_id", c, "customer_id", "orders.customer_id -> customers"),
        dq.fk_orphans(i, "order_id", o, "order_id", "order_items.order_id -> orders"),
        dq.fk_orphans(i, "product_id", p, "product_id", "order_items.product_id -> products"),
    ])


@register("dirty_duplicate_names", orc.dirty_duplicate_names())
def q_dirty_duplicate_names(spark, sf_dir):
    """A text natural key (the customer's name plays the e-mail address), some repeated in other cases."""
    names = tb.raw(spark, sf_dir, "customer").selectExpr(
        "lower(CASE WHEN c_custkey % 90 = 0 THEN concat('Customer#', CAST(c_custkey % 450 AS STRING)) ELSE c_name END) AS email")
    return dq.duplicate_keys(names, ["email"])


@register("dirty_order_total_rollup", orc.dirty(orc.order_total_rollup()))
def q_dirty_order_total_rollup(spark, sf_dir):
    _, o, i = dirty_model(spark, sf_dir)
    return rollup.order_total_rollup(o, rollup.item_price_lookup(i, tb.products(spark, sf_dir)))


FRACTIONS = {"order_count": "CASE WHEN customer_id % 9 = 4 THEN -order_count - 0.75D ELSE order_count + 0.75D END",
             "distinct_products": "distinct_products * 1.3D", "recency_days": "recency_days + 0.9D", "tenure_days": "tenure_days / 7D"}


@register("dirty_fractional_transform", orc.dirty_fractional_transform(CUTOFF))
def q_dirty_fractional_transform(spark, sf_dir):
    """Counts that are no whole numbers are cut towards zero, negative ones too."""
    rows = dirty_features(spark, sf_dir).selectExpr("customer_id", *[f"{sql} AS {f}" for f, sql in FRACTIONS.items()])
    return transform_features(rows)


@register("dirty_fractional_rollup", orc.dirty_fractional_rollup())
def q_dirty_fractional_rollup(spark, sf_dir):
    """Prices in tenths of a cent: totals are rounded half-even to cents, ties among them."""
    _, o, i = dirty_model(spark, sf_dir)
    tenths = tb.products(spark, sf_dir).selectExpr(
        "product_id", "CAST(unit_price AS DECIMAL(12,3)) + CAST(CAST(product_id % 10 AS DECIMAL(4,0)) / 1000 AS DECIMAL(6,3)) AS unit_price")
    return rollup.order_total_rollup(o, rollup.item_price_lookup(i, tenths))


@register("dirty_report_without_columns", orc.dirty_report_without_columns(CUTOFF))
def q_dirty_report_without_columns(spark, sf_dir):
    """The report of a frame that lacks two required columns, and of one without rows."""
    rows = dirty_features(spark, sf_dir)
    named = lambda frame, df: dq.validate_report(df).select(F.lit(frame).alias("frame"), "*")
    return named("narrow", rows.drop("total_spend", "churned")).unionAll(named("empty", rows.where("customer_id IS NULL")))


@register("dirty_score_rejects", orc.dirty_score_rejects(CUTOFF))
def q_dirty_score_rejects(spark, sf_dir):
    """Every request field breaks its rule somewhere."""
    return sc.split_requests(dirty_requests(spark, sf_dir))[1].select("customer_id", *FEATURE_COLUMNS, "reject_reason")


BAD_FIELDS = orc.BAD_FIELDS


def dirty_requests(spark, sf_dir):
    return requests_as_of(*dirty_model(spark, sf_dir), CUTOFF).selectExpr(
        "customer_id", *[f"CASE WHEN customer_id % {m} = 0 THEN -{f} - 1 ELSE {f} END AS {f}" for f, m in BAD_FIELDS.items()])


# ------------------------------------------------------- delimited tables


@register("csv_orders", orc.csv_orders())
def q_csv_orders(spark, sf_dir):
    """Orders as a delimited table with a header, empty fields for NULL, read
    back with the declared schema."""
    path = scratch_path(spark, "orders-csv")
    rows = dirty.orders(spark, sf_dir).selectExpr(
        "order_id", "customer_id", "order_date", "CASE WHEN order_id % 31 <> 0 THEN status END AS status", "order_total")
    (rows.write.option("header", True).option("nullValue", "").option("timestampNTZFormat", "yyyy-MM-dd HH:mm:ss").csv(path))
    back = read_csv_table(spark, path, ORDERS)
    return back.withColumn("order_total", F.col("order_total").cast("double"))


# ----------------------------------------------------------------- layout

@register("feature_table_bucketed", orc.feature_table(CUTOFF))
def q_feature_table_bucketed(spark, sf_dir):
    """Feature table over the bucketed layout (customers and orders by
    customer_id, items by order_id; written once per call here, once per
    refresh in production): 3 shuffles instead of 8."""
    from pitstop.sources.layout import bucketed_model
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return ft.feature_table(*bucketed_model(spark, *model(spark, sf_dir), n), CUTOFF)
