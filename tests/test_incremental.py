"""Feature tables from folded states against the tables built from all orders."""

import datetime as dt

import pytest
from fixtures import C, edge_tables
from pyspark.sql import functions as F

from pitstop import registry as R
from pitstop.operators import equivalence, incremental
from pitstop.operators import features as ft
from pitstop.session import scratch_path

SF = "/root/testdata/sf0.001"
CUTOFFS = [dt.date(1995, 6, 1), dt.date(1997, 1, 1), dt.date(1998, 1, 1)]


def folded(spark, path, tables, arrival, cutoffs, again=()):
    c, o, i = tables
    previous = None
    for k, cutoff in enumerate(cutoffs):
        feed = o.where(arrival == k)
        for _ in range(2 if k in again else 1):
            incremental.fold(spark, path, previous, cutoff, feed, i.join(feed.select("order_id"), "order_id", "left_semi"))
        previous = cutoff


@pytest.mark.parametrize("source", ["clean", "dirty"])
def test_two_increments_equal_one_pass_over_all_orders(spark, source):
    """Every 5th order is late by one increment; the last increment brings all that is left."""
    c, o, i = R.model(spark, SF) if source == "clean" else R.dirty_model(spark, SF)
    o = R.staged(o, "orders")
    arrival = F.least(F.expr("CASE WHEN order_date <= TIMESTAMP_NTZ '1995-06-01 00:00:00' THEN 0 WHEN order_date <= "
                             "TIMESTAMP_NTZ '1997-01-01 00:00:00' THEN 1 ELSE 2 END") + (F.col("order_id") % 5 == 0).cast("int"), F.lit(2))
    path = scratch_path(spark, "fold")
    folded(spark, path, (c, o, i), arrival, CUTOFFS, again=(1, 2))       # a fold that runs twice writes the same
    got = incremental.features_from_state(spark, path, CUTOFFS[-1], c)
    want = ft.multi_cutoff_features(c, o, i, CUTOFFS).where(F.col("cutoff_date") == F.lit(CUTOFFS[-1]))
    assert equivalence.difference(got, want.select(*got.columns)).collect() == []
    # the version before knows what had arrived by then, not the late orders
    known = o.where(arrival <= 1)
    then = incremental.features_from_state(spark, path, CUTOFFS[1], c)
    as_of = ft.multi_cutoff_features(c, known, i, CUTOFFS[:2]).where(F.col("cutoff_date") == F.lit(CUTOFFS[1]))
    assert equivalence.difference(then, as_of.select(*then.columns)).collect() == []
    all_known = ft.multi_cutoff_features(c, o, i, CUTOFFS[:2]).where(F.col("cutoff_date") == F.lit(CUTOFFS[1]))
    assert not equivalence.equivalent(then, all_known.select(*then.columns))


def test_boundaries_and_empty_increments(spark):
    c, o, i = edge_tables(spark)
    path = scratch_path(spark, "fold-edge")
    early = dt.date(2025, 12, 15)
    nothing = o.limit(0)
    incremental.fold(spark, path, None, early, nothing, i.limit(0))
    incremental.fold(spark, path, early, C, o, i)                        # all of it late
    got = incremental.features_from_state(spark, path, C, c).drop("cutoff_date")
    want = ft.feature_table(c, o, i, C)
    assert equivalence.difference(got.select(*want.columns), want).collect() == []
    later = dt.date(2026, 3, 1)
    incremental.fold(spark, path, C, later, nothing, i.limit(0))         # nothing arrives: only time passes
    got = incremental.features_from_state(spark, path, later, c).drop("cutoff_date")
    assert equivalence.difference(got.select(*want.columns), ft.feature_table(c, o, i, later)).collect() == []
    with pytest.raises(ValueError):
        incremental.fold(spark, path, later, C, o, i)
