"""Property tests on random small inputs (hypothesis)."""

import datetime as dt
from decimal import Decimal

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from test_drift import numpy_psi

from pitstop.operators import drift
from pitstop.operators import features as ft
from pitstop.sources import schemas as S

SETTINGS = settings(max_examples=8, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])

BASE = dt.datetime(2026, 1, 1)
order_st = st.tuples(st.integers(1, 6),                              # customer
                     st.one_of(st.none(), st.integers(-200, 200)),   # day offset (NULL allowed)
                     st.integers(0, 1),                              # +1 second
                     st.sampled_from(["completed", "pending", "cancelled"]),
                     st.integers(0, 10_000))                         # cents


@SETTINGS
@given(orders=st.lists(order_st, max_size=40),
       items=st.lists(st.tuples(st.integers(0, 39), st.integers(1, 5)), max_size=60),
       cut_days=st.lists(st.integers(-150, 150), min_size=1, max_size=5, unique=True))
def test_multi_cutoff_equals_single_cutoffs(spark, orders, items, cut_days):
    customers = spark.createDataFrame(
        [(c, None, None, None, dt.date(2025, 1, c), "X", None) for c in range(1, 7)], S.CUSTOMERS)
    o_rows = [(i, c, None if d is None else BASE + dt.timedelta(days=d, seconds=s), st_, Decimal(cents) / 100)
              for i, (c, d, s, st_, cents) in enumerate(orders)]
    o = spark.createDataFrame(o_rows, S.ORDERS)
    it = spark.createDataFrame([(k, oid, pid, 1, None) for k, (oid, pid) in enumerate(items)],
                               S.ORDER_ITEMS)
    cutoffs = [(BASE + dt.timedelta(days=d)).date() for d in cut_days]
    multi = ft.multi_cutoff_features(customers, o, it, cutoffs).collect()
    got = {(r.cutoff_date, r.customer_id): r.asDict() for r in multi}
    for c in cutoffs:
        for r in ft.feature_table(customers, o, it, c).collect():
            want = r.asDict()
            have = dict(got[(c, r.customer_id)])
            have.pop("cutoff_date")
            assert have == want


@SETTINGS
@given(values=st.lists(st.one_of(st.integers(-50, 50).map(float),
                                 st.floats(-1e6, 1e6, allow_nan=False, allow_infinity=False)),
                       min_size=1, max_size=300),
       blocks=st.integers(1, 7))
def test_exact_quantiles_match_numpy(spark, values, blocks):
    df = spark.createDataFrame([("g", v) for v in values], "g string, v double")
    q = drift.exact_quantiles(df, "g", "v", drift.quantile_probs(10), num_blocks=blocks)
    got = [r.quantile for r in q.orderBy("q_idx").collect()]
    assert got == list(np.quantile(np.array(values), np.linspace(0, 1, 11)))


@SETTINGS
@given(e=st.lists(st.integers(0, 30).map(float), min_size=0, max_size=120),
       a=st.lists(st.integers(-5, 40).map(float), min_size=0, max_size=120))
def test_psi_matches_numpy(spark, e, a):
    got = drift.psi_value(e, a, spark=spark)
    if not e:
        assert got is None
    else:
        assert got == pytest.approx(numpy_psi(e, a), rel=1e-12, abs=1e-12)
