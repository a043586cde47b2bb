import datetime as dt

import pytest
from fixtures import C, EXPECTED, edge_tables
from pyspark.sql import functions as F

from pitstop.operators import features as ft
from pitstop.plans import feature_sql as fsql
from pitstop.sources import tables as tb

COLS = ["order_count", "total_spend", "distinct_products", "recency_days", "tenure_days",
        "orders_next_90d", "churned"]


def rows(df):
    return {r["customer_id"]: tuple(r[c] for c in COLS) for r in df.collect()}


@pytest.mark.parametrize("fn", [ft.feature_table, ft.feature_table_grouped])
def test_boundary_rows(spark, fn):
    c, o, i = edge_tables(spark)
    assert rows(fn(c, o, i, C)) == EXPECTED


def test_feature_schema(spark):
    from pitstop.sources.schemas import FEATURE_TABLE
    c, o, i = edge_tables(spark)
    df = ft.feature_table(c, o, i, C)
    assert [(f.name, f.dataType) for f in df.schema.fields] == \
        [(f.name, f.dataType) for f in FEATURE_TABLE.fields]
    assert df.where(F.col("customer_id") == 1).first()["last_order_date"] == dt.datetime(2026, 1, 1)


def test_multi_cutoff_equals_single_cutoffs(spark):
    c, o, i = edge_tables(spark)
    cutoffs = [dt.date(2025, 12, 1), C, dt.date(2026, 1, 5), dt.date(2026, 3, 1)]
    multi = ft.multi_cutoff_features(c, o, i, cutoffs)
    for d in cutoffs:
        single = ft.feature_table(c, o, i, d).withColumn("cutoff_date", F.lit(d))
        part = multi.where(F.col("cutoff_date") == d)
        assert part.exceptAll(single.select(multi.columns)).count() == 0
        assert single.select(multi.columns).exceptAll(part).count() == 0


@pytest.mark.parametrize("cutoff", ["1995-03-01", "1998-01-01", "2001-01-01"])
def test_forms_agree_on_test_data(spark, cutoff):
    sf = "/root/testdata/sf0.001"
    c, o, i = tb.customers(spark, sf), tb.orders(spark, sf), tb.order_items(spark, sf)
    fused = ft.feature_table(c, o, i, cutoff).cache()
    for other in (ft.feature_table_grouped(c, o, i, cutoff), fsql.feature_table_sql(spark, sf, cutoff)):
        assert fused.exceptAll(other).count() == 0 and other.exceptAll(fused).count() == 0
    corr = fsql.feature_table_correlated(spark, sf, cutoff).cache()   # materialise first
    corr.count()
    shared = fused.select(corr.columns)
    assert shared.exceptAll(corr).count() == 0 and corr.exceptAll(shared).count() == 0


def test_customer_sample_pushes_key_range(spark):
    c, o, i = edge_tables(spark)
    df = ft.customer_sample(ft.feature_table, c, o, i, C, 3)
    assert sorted(r.customer_id for r in df.collect()) == [1, 2, 3]


def test_cutoff_filter_reaches_scan(spark):
    sf = "/root/testdata/sf0.001"
    df = ft.feature_table(tb.customers(spark, sf), tb.orders(spark, sf), tb.order_items(spark, sf),
                          "1998-01-01")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "LessThanOrEqual(o_orderdate,1998-04-01T00:00)" in plan
    assert "LessThanOrEqual(o_orderdate,1998-01-01T00:00)" in plan


def test_bucketed_layout_same_result_fewer_shuffles(spark):
    from pitstop.sources.layout import bucketed_model
    sf = "/root/testdata/sf0.001"
    args = (tb.customers(spark, sf), tb.orders(spark, sf), tb.order_items(spark, sf))
    bucketed = ft.feature_table(*bucketed_model(spark, *args, 8), "1998-01-01")
    plain = ft.feature_table(*args, "1998-01-01")
    assert bucketed.exceptAll(plain).count() == 0 and plain.exceptAll(bucketed).count() == 0
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        def shuffles(df):
            qe = df._jdf.sparkSession().sessionState().executePlan(
                df._jdf.queryExecution().logical(), df._jdf.queryExecution().mode())
            return qe.executedPlan().toString().count("Exchange hashpartitioning")
        assert shuffles(bucketed) < shuffles(plain)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 << 20))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_correlated_forms_agree_and_are_decorrelated(spark):
    """The five scalar subqueries, COUNT of nothing among them, and the lateral aggregates."""
    from pitstop.plans import feature_sql as fsql
    c, o, i = edge_tables(spark)
    scalar = fsql.feature_sql_on(fsql.CORRELATED_SQL, c, o, i, C)
    lateral = fsql.feature_sql_on(fsql.LATERAL_SQL, c, o, i, C)
    key = lambda r: r.customer_id
    assert sorted(scalar.collect(), key=key) == sorted(lateral.collect(), key=key)
    got = {r.customer_id: (r.order_count, r.total_spend, r.distinct_products, r.orders_next_90d) for r in scalar.collect()}
    assert got == {k: (*v[:3], v[5]) for k, v in EXPECTED.items()}
    plan = scalar._jdf.queryExecution().optimizedPlan().toString()
    assert "scalar-subquery" not in plan and plan.count("Join LeftOuter") == 5
    assert fsql.CORRELATED_SQL.count("(SELECT ") == 5
