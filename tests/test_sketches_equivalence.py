"""Mergeable sketches against exact answers, and the multiset comparison of frames."""

import datetime as dt
import random
from collections import Counter

import numpy as np
import pytest
from fixtures import C, edge_tables

from pitstop.operators import drift, equivalence, sketches
from pitstop.operators import features as ft


def test_small_counts_are_exact_and_merge_over_cutoffs(spark):
    c, o, i = edge_tables(spark)
    cutoffs = [dt.date(2025, 11, 1), dt.date(2025, 12, 15), C, dt.date(2027, 1, 1)]
    got = {(r.cutoff_date, r.customer_id): r.distinct_products for r in sketches.approx_past_products(o, i, cutoffs).collect()}
    want = {(d, r.customer_id): r.distinct_products for d in cutoffs for r in ft.past_products(o, i, d).collect() if r.distinct_products}
    assert got == want and len(want) >= 4


def test_estimates_of_many_products_are_near_and_late_sketches_merge(spark):
    rng, rows = random.Random(1), []
    for k in range(30_000):
        rows.append((k, rng.choice("xy"), dt.datetime(2025, 1, 1) + dt.timedelta(days=rng.randrange(300))))
    o = spark.createDataFrame(rows, "order_id long, key string, order_date timestamp_ntz")
    i = spark.createDataFrame([(k, rng.randrange(20_000)) for k in range(30_000)] + [(5, None)], "order_id long, product_id long")
    cutoffs = [dt.date(2025, 3, 1), dt.date(2025, 6, 1), dt.date(2026, 1, 1)]
    product = {r.order_id: r.product_id for r in i.collect() if r.product_id is not None}
    parts = [sketches.product_sketches(o.where(f"order_id % 2 = {k}"), i, cutoffs, ["key"]) for k in (0, 1)]
    for got in (sketches.approx_past_products(o, i, cutoffs, ["key"]),
                sketches.merged_counts(parts[0].unionAll(parts[1]), cutoffs, ["key"])):      # two loads, merged
        rows_out = got.collect()
        assert len(rows_out) == 6
        for r in rows_out:
            exact = len({product[k] for k, key, at in rows if key == r.key and at <= dt.datetime.combine(r.cutoff_date, dt.time())})
            assert abs(r.distinct_products - exact) <= 4 * sketches.relative_error() * exact


def test_a_range_of_days_is_a_merge_of_its_days(spark):
    rng, start = np.random.default_rng(2), dt.datetime(2024, 5, 1)
    rows = [(g, start + dt.timedelta(hours=int(rng.integers(0, 240))), float(v)) for g in ("a", None) for v in rng.normal(0, 1, 6000)]
    rows += [("tied", start, float(k % 3)) for k in range(900)] + [("one", start, 4.0)] * 5 + [("none", start, None), ("a", start, float("nan")), ("a", None, 1.0)]
    df = spark.createDataFrame(rows, "g string, ts timestamp_ntz, v double")
    days = sketches.daily_sketches(df, "g", "v", "ts")
    first, last = dt.date(2024, 5, 1), dt.date(2024, 5, 6)
    prof = {r.g: r for r in sketches.sketch_profile(days, "g", first, last).collect()}
    assert set(prof) == {"a", None, "tied", "one"}
    for g, r in prof.items():
        x = np.sort([v for k, t, v in rows if k == g and t and v is not None and v == v and first <= t.date() <= last])
        assert r.n_expected == len(x) and r.edges[0] == x[0] and r.edges[-1] == x[-1]
        counts = np.histogram(x, r.edges)[0] if len(r.edges) > 1 else []
        assert np.abs(np.array(r.e_counts) - counts).max(initial=0) <= 0.02 * len(x) and len(r.e_counts) == len(counts)
        for q, e in zip(drift.quantile_probs(), r.edges) if g in ("a", None) else ():
            assert (x < e).mean() - 0.02 <= q <= (x <= e).mean() + 0.02
    psi = drift.grouped_psi(df.where("ts is not null"), sketches.sketch_profile(days, "g", first, last), "g", "v").collect()
    assert {r.g: r.verdict for r in psi} == {"a": "OK", None: "OK", "tied": "OK", "one": "OK"}


SCHEMA = "k long, t string, x double, d date"


def rows(seed=0, n=500):
    rng = random.Random(seed)
    return [(rng.choice([None, 1, 2, 3]), rng.choice([None, "", "a", "bé"]), rng.choice([None, 0.0, -0.0, 1.5, float("nan")]),
             rng.choice([None, dt.date(2020, 1, 1)])) for _ in range(n)]


def test_order_partitions_and_columns_do_not_matter(spark):
    a = spark.createDataFrame(rows(), SCHEMA)
    b = a.repartition(7).select("x", "d", "k", "t")
    assert equivalence.equivalent(a, b) and equivalence.difference(a, b).count() == 0
    zeros = spark.createDataFrame([(1, "a", 0.0, None)], SCHEMA), spark.createDataFrame([(1, "a", -0.0, None)], SCHEMA)
    assert equivalence.equivalent(*zeros)


@pytest.mark.parametrize("buckets", [1, 4, 4096])
def test_difference_is_that_of_multisets(spark, buckets):
    left = rows()
    right = [r for k, r in enumerate(left) if k % 97 != 5] + left[:3] + [(9, "new", 2.0, None), (None, None, None, None)]
    a, b = spark.createDataFrame(left, SCHEMA), spark.createDataFrame(right, SCHEMA)
    plain = lambda r: tuple("nan" if v != v else 0.0 if v == 0 and isinstance(v, float) else v for v in r)
    m, n = Counter(map(plain, left)), Counter(map(plain, right))
    want = {r: (m[r], n[r]) for r in m | n if m[r] != n[r]}
    got = {plain(r[:4]): (r.n_left, r.n_right) for r in equivalence.difference(a, b, buckets).collect()}
    assert got == want and not equivalence.equivalent(a, b, buckets)


def test_a_null_is_not_a_missing_column_value(spark):
    a = spark.createDataFrame([("x", None), (None, "x")], "p string, q string")
    b = spark.createDataFrame([("x", None), ("x", None)], "p string, q string")
    assert not equivalence.equivalent(a, b)
    with pytest.raises(ValueError):
        equivalence.equivalent(a, b.withColumnRenamed("q", "r"))
    empty = a.limit(0)
    assert equivalence.equivalent(empty, empty) and equivalence.difference(a, empty).count() == 2


def test_products_by_country_are_counted_without_a_copy_of_each_row_for_each_cutoff(spark, tmp_path):
    """Null keys, products and dates, rows that come twice, and an order beyond the last cutoff."""
    from pitstop.registry import BACKTEST_CUTOFFS, QUERIES
    from pitstop.sources.tables import DRIVER_SCHEMAS
    rng = random.Random(7)
    midnight = [dt.datetime.combine(d, dt.time()) for d in BACKTEST_CUTOFFS]
    dates = [*midnight, midnight[2] + dt.timedelta(seconds=1), dt.datetime(2001, 1, 1), None]
    names = {1: "FR", 2: "DE", None: None}
    nation = {k: rng.choice([1, 2, None]) for k in range(30)}
    placed = [(rng.choice([*range(200), None]), rng.choice([*range(30), 99, None]), "F", 1.0, rng.choice(dates), "x") for _ in range(300)]
    lines = [(rng.choice([*range(210), None]), rng.choice([*range(60), None]), 1, k % 7, 1.0, 1.0, 0.0, 0.0, "N", "O", None) for k in range(900)]
    tables = {"nation": [(k, v, 0) for k, v in names.items() if k], "orders": placed * 2, "lineitem": lines,
              "customer": [(k, "c", n, 0.0, "m") for k, n in nation.items()]}
    for name, body in tables.items():
        spark.createDataFrame(body, DRIVER_SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    want = {}
    for order, customer, _, _, at, _ in placed:
        country = names[nation.get(customer)]
        for d, until in zip(BACKTEST_CUTOFFS, midnight):
            if country and order is not None and at is not None and at <= until:
                want.setdefault((d, country), set()).update(x[1] for x in lines if x[0] == order and x[1] is not None)
    df = QUERIES["approx_distinct_products"](spark, str(tmp_path))
    got = [(r.cutoff_date, r.country, r.exact, r.within_bound) for r in df.collect()]
    assert sorted(got) == sorted((*k, len(v), True) for k, v in want.items() if v) and len(got) == 14
    assert "Expand" not in df._jdf.queryExecution().executedPlan().toString()   # a row a cutoff filled each task's memory
