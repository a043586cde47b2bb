import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from pitstop.operators import drift


def numpy_psi(expected, actual, buckets=10):
    """The reference formula, re-derived with numpy for comparison."""
    e = np.asarray([x for x in expected if x is not None and not math.isnan(x)], dtype=float)
    a = np.asarray([x for x in actual if x is not None and not math.isnan(x)], dtype=float)
    edges = np.unique(np.quantile(e, np.linspace(0, 1, buckets + 1)))
    if len(edges) < 2:
        return 0.0
    ec = np.clip(np.histogram(e, bins=edges)[0] / len(e), 1e-4, None)
    ac = np.clip(np.histogram(a, bins=edges)[0] / max(len(a), 1), 1e-4, None)
    return float(np.sum((ac - ec) * np.log(ac / ec)))


def psi(spark, e, a):
    return drift.psi_value(e, a, spark=spark)


def test_probs_match_linspace():
    assert drift.quantile_probs(10) == list(np.linspace(0, 1, 11))


def test_identical_and_constant(spark):
    x = list(range(1, 1001))
    assert psi(spark, x, x) == 0.0
    assert psi(spark, [7.0] * 100, [1.0, 2.0, 3.0]) == 0.0


def test_empty_live(spark):
    assert psi(spark, [1, 2, 3, 4], []) == pytest.approx(7.820916392, abs=1e-9)


def test_empty_expected_is_no_data(spark):
    e = spark.createDataFrame([], "x double")
    a = spark.createDataFrame([(1.0,)], "x double")
    r = drift.psi_report(e, a, ["x"]).first()
    assert r.psi is None and r.verdict == "NO_DATA"


def test_out_of_range_in_denominator(spark):
    e = spark.createDataFrame([(float(x),) for x in range(1, 101)], "x double")
    a = spark.createDataFrame([(float(x),) for x in range(1, 101)] + [(1000.0,)] * 100, "x double")
    r = drift.psi_report(e, a, ["x"]).first()
    assert r.n_actual == 200 and r.n_out_of_range == 100
    assert r.psi == pytest.approx(numpy_psi(range(1, 101), list(range(1, 101)) + [1000.0] * 100),
                                  abs=1e-12)


def test_last_edge_in_last_bin_and_nulls_dropped(spark):
    e = [1.0, 2.0, 3.0, 4.0, None, float("nan")]
    a = [4.0, 4.0, None]
    assert psi(spark, e, a) == pytest.approx(numpy_psi(e, a), abs=1e-12)
    h = drift.psi_histogram(spark.createDataFrame([(x,) for x in e], "x double"),
                            spark.createDataFrame([(x,) for x in a], "x double"), ["x"])
    last = h.where((F.col("side") == "actual")).orderBy(F.desc("bin")).first()
    assert last.n == 2


def test_missing_feature_skipped(spark):
    e = spark.createDataFrame([(1.0, 2.0)], "x double, y double")
    a = spark.createDataFrame([(1.0,)], "x double")
    assert [r.feature for r in drift.psi_report(e, a, ["x", "y"]).collect()] == ["x"]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_random_against_numpy(spark, seed):
    rng = np.random.default_rng(seed)
    e = np.round(rng.lognormal(3, 1.5, 3000), 2).tolist()
    a = np.round(rng.lognormal(3.3, 1.4, 1700), 2).tolist()
    assert psi(spark, e, a) == pytest.approx(numpy_psi(e, a), rel=1e-12, abs=1e-14)


def test_exact_quantiles_bit_equal(spark):
    rng = np.random.default_rng(7)
    vals = np.concatenate([rng.normal(size=2000), np.full(700, 0.25), rng.integers(0, 5, 300)])
    pdf = pd.DataFrame({"g": ["a"] * len(vals), "v": vals})
    q = (drift.exact_quantiles(spark.createDataFrame(pdf), "g", "v", drift.quantile_probs(10),
                               num_blocks=5).orderBy("q_idx").collect())
    assert [r.quantile for r in q] == list(np.quantile(vals, np.linspace(0, 1, 11)))


def test_grouped_psi_matches_per_group_numpy(spark):
    rng = np.random.default_rng(11)
    rows = [("a", float(x)) for x in rng.normal(size=500)] + \
           [("b", float(x)) for x in rng.exponential(size=400)]
    live = [("a", float(x)) for x in rng.normal(0.5, size=300)] + \
           [("b", float(x)) for x in rng.exponential(2.0, size=200)]
    e = spark.createDataFrame(rows, "g string, v double")
    a = spark.createDataFrame(live, "g string, v double")
    prof = drift.expected_profile(e, "g", "v")
    got = {r.g: r.psi for r in drift.grouped_psi(a, prof, "g", "v").collect()}
    for g in ("a", "b"):
        want = numpy_psi([v for k, v in rows if k == g], [v for k, v in live if k == g])
        assert got[g] == pytest.approx(want, rel=1e-12)


def test_verdicts(spark):
    df = spark.createDataFrame([(0.05,), (0.1,), (0.2,), (0.25,), (None,)], "p double")
    got = [r[0] for r in df.select(drift.psi_verdict(F.col("p"))).collect()]
    assert got == ["OK", "INVESTIGATE", "INVESTIGATE", "RETRAIN", "NO_DATA"]


def test_grouped_psi_of_ten_thousand_groups(spark):
    n = 10_000
    e = spark.range(n * 20).selectExpr("CAST(id % 10000 AS INT) AS g", "CAST((id * 7919) % 31 AS DOUBLE) AS v")
    a = spark.range(n * 10).selectExpr("CAST(id % 10000 AS INT) AS g", "CAST((id * 104729) % 37 AS DOUBLE) AS v")
    got = {r.g: r.psi for r in drift.grouped_psi(a, drift.expected_profile(e, "g", "v"), "g", "v").collect()}
    assert len(got) == n
    for g in (0, 4321, 9999):
        want = numpy_psi([(i * 7919) % 31 for i in range(g, n * 20, n)], [(i * 104729) % 37 for i in range(g, n * 10, n)])
        assert got[g] == pytest.approx(want, rel=1e-9)


def test_unseen_null_and_non_string_groups_keep_their_rows(spark):
    e = spark.createDataFrame([(None, float(i)) for i in range(40)] + [(1, float(i % 7)) for i in range(40)] + [(2, 3.0)] * 5,
                              "g int, v double")
    a = spark.createDataFrame([(None, float(i)) for i in range(40)] + [(3, 1.0)] * 500 + [(2, 9.0)] * 4 + [(4, None)], "g int, v double")
    got = {r.g: r for r in drift.grouped_psi(a, drift.expected_profile(e, "g", "v"), "g", "v").collect()}
    assert set(got) == {None, 2, 3}
    assert got[None].psi == pytest.approx(0.0) and got[None].verdict == "OK"
    assert got[3].psi is None and got[3].verdict == "NO_DATA" and got[3].n_actual == 500
    assert got[2].psi == 0.0 and got[2].n_out_of_range == 4
