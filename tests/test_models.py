"""Newton logistic regression and second-order boosted trees against Spark ML,
numpy and exhaustive search."""

import math
import random

import numpy as np
import pytest
from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.sql import functions as F

from pitstop import registry as R
from pitstop.operators import boosting, logistic
from pitstop.operators.metrics import roc_auc
from pitstop.operators.train import BOOSTED, BOOSTED_PARAMS, fit, predict

SF = "/root/testdata/sf0.001"
FEATURES = ["a", "b", "c"]
SCHEMA = "a double, b long, c double, churned int"


def sample(n=300, seed=3, noise=1.0):
    rng = random.Random(seed)
    rows = []
    for _ in range(n):
        a, b, c = rng.gauss(5, 2), rng.randint(0, 6), rng.random()
        rows.append((a, b, c, int(0.8 * (a - 5) - 0.5 * (b - 3) + noise * rng.gauss(0, 1) > 0)))
    return rows


def design(rows):
    x = np.array([r[:3] for r in rows], float)
    s = x.std(axis=0, ddof=1)
    z = np.where(s > 0, (x - x.mean(axis=0)) / np.where(s > 0, s, 1), 0)
    return np.hstack([np.ones((len(rows), 1)), z]), np.array([r[3] for r in rows], float)


def test_newton_equals_spark_ml(spark):
    rows = spark.createDataFrame(sample(), SCHEMA)
    got = logistic.fit_logistic(rows, FEATURES, c=0.5)
    scaled = StandardScaler(inputCol="raw", outputCol="features", withMean=True, withStd=True)
    vec = VectorAssembler(inputCols=FEATURES, outputCol="raw").transform(rows)
    ready = scaled.fit(vec).transform(vec)
    lr = LogisticRegression(labelCol="churned", regParam=1 / (0.5 * 300), elasticNetParam=0.0, standardization=False,
                            maxIter=1000, tol=1e-14).fit(ready)
    assert np.abs(np.array(got.weights) - lr.coefficients.toArray()).max() < 1e-6
    assert abs(got.intercept - lr.intercept) < 1e-6 and got.steps < 12


@pytest.mark.parametrize("noise,c", [(1.0, 1.0), (0.0, 1e4), (3.0, 1e-3)])
def test_the_gradient_is_zero_at_the_optimum(spark, noise, c):
    rows = sample(noise=noise)
    got = logistic.fit_logistic(spark.createDataFrame(rows, SCHEMA), FEATURES, c=c)
    x, y = design(rows)
    w = np.array([got.intercept, *got.weights])
    gradient = x.T @ (1 / (1 + np.exp(-x @ w)) - y) + np.array([0, *[1 / c] * 3]) * w
    assert np.abs(gradient).max() < 1e-7 and np.abs(np.array(got.gradient)).max() < 1e-7
    scores = [r.p for r in spark.createDataFrame(rows, SCHEMA).select(got.score().alias("p")).collect()]
    assert np.allclose(scores, 1 / (1 + np.exp(-x @ w)), atol=1e-12)


def test_newton_on_odd_rows(spark):
    rows = sample(60)
    odd = [(a, 4, c, y) for a, _, c, y in rows] + [(None, 4, 0.1, 1), (1.0, None, 0.1, 0), (1.0, 4, 0.2, None)]
    got = logistic.fit_logistic(spark.createDataFrame(odd, SCHEMA), FEATURES)
    assert got.n == 60 and got.weights[1] == 0 and abs(got.weights[0]) > 0.1
    one = logistic.fit_logistic(spark.createDataFrame([(1.0, 1, 1.0, 1)] * 3, SCHEMA), FEATURES)
    assert one.intercept == math.inf and one.weights == [0.0] * 3
    assert spark.createDataFrame(rows, SCHEMA).select(one.score().alias("p")).distinct().collect()[0].p == 1.0
    with pytest.raises(ValueError):
        logistic.fit_logistic(spark.createDataFrame([], SCHEMA), FEATURES)


def brute_trees(rows, trees, depth, rate, unit=boosting.UNIT):
    """Every split of every node tried on the rows themselves."""
    x = [r[:3] for r in rows]
    y = [r[3] for r in rows]
    ones = sum(y)
    margin = [math.log(ones / (len(y) - ones))] * len(y)
    value = lambda g, h: float(g) * float(g) / float(max(h, 1))
    for _ in range(trees):
        p = [1 / (1 + math.exp(-m)) for m in margin]
        g = [math.floor((q - t) * unit + 0.5) for q, t in zip(p, y)]
        h = [math.floor(q * (1 - q) * unit + 0.5) for q in p]
        nodes = [(list(range(len(y))), 0)]
        while nodes:
            mine, level = nodes.pop()
            all_g, all_h = sum(g[i] for i in mine), sum(h[i] for i in mine)
            best, cut = 0.0, None
            for f in range(3) if level < depth else ():
                for edge in sorted({x[i][f] for i in mine})[1:]:
                    left = [i for i in mine if x[i][f] < edge]
                    gl, hl = sum(g[i] for i in left), sum(h[i] for i in left)
                    gain = value(gl, hl) + value(all_g - gl, all_h - hl) - value(all_g, all_h)
                    if gain > best:
                        best, cut = gain, (f, edge)
            if cut is None:
                for i in mine:
                    margin[i] += -(all_g / max(all_h, 1)) * rate
            else:
                f, edge = cut
                nodes += [([i for i in mine if x[i][f] < edge], level + 1), ([i for i in mine if x[i][f] >= edge], level + 1)]
    return margin


@pytest.mark.parametrize("restage", [2, 10])
def test_trees_equal_exhaustive_search(spark, restage):
    rng = random.Random(9)
    rows = [(float(rng.randint(0, 7)), rng.randint(0, 5), rng.randint(0, 9) / 4, 0) for _ in range(160)]
    rows = [(a, b, c, int(a + b * c + rng.gauss(0, 2) > 7)) for a, b, c, _ in rows]
    df = spark.createDataFrame(rows, SCHEMA)
    # as many bins as it takes for every value to be a bin of its own
    model = boosting.fit_boosted(df, FEATURES, trees=5, depth=3, max_bins=400, restage=restage)
    got = df.select(model.margin().alias("m")).collect()
    assert np.allclose([r.m for r in got], brute_trees(rows, 5, 3, 0.1), atol=1e-9)
    assert {r.tree for r in model.table(spark).collect()} == set(range(5))


def test_trees_do_not_depend_on_the_order_of_rows(spark):
    df = spark.createDataFrame(sample(200), SCHEMA)
    models = [boosting.fit_boosted(d, FEATURES, trees=3) for d in (df, df.repartition(7).orderBy(F.rand(1)))]
    assert models[0] == models[1]


def test_trees_on_odd_rows(spark):
    flat = spark.createDataFrame([(1.0, 1, 1.0, k % 3 == 0) for k in range(9)], "a double, b long, c double, churned boolean")
    model = boosting.fit_boosted(flat.withColumn("churned", F.col("churned").cast("int")), FEATURES, trees=2)
    assert all(not t.splits for t in model.trees) and abs(model.prior - math.log(0.5)) < 1e-12
    one = boosting.fit_boosted(spark.createDataFrame([(1.0, 1, 1.0, 0)] * 2, SCHEMA), FEATURES, trees=2)
    assert one.prior == -math.inf and not one.trees
    with_nulls = sample(80) + [(None, 1, 1.0, 1), (1.0, 1, None, 0)]
    assert boosting.fit_boosted(spark.createDataFrame(with_nulls, SCHEMA), FEATURES, trees=1) == boosting.fit_boosted(
        spark.createDataFrame(sample(80), SCHEMA), FEATURES, trees=1)
    with pytest.raises(ValueError):
        boosting.fit_boosted(spark.createDataFrame([], SCHEMA), FEATURES)


def test_auc_is_that_of_the_library_model(spark):
    """The same settings, depth and rate; histogram Newton trees against Spark's own boosting."""
    train, test = R.split_parts(spark, "/root/testdata/sf0.01")
    ours = boosting.fit_boosted(train, trees=25)
    theirs = fit(BOOSTED, train, boosted_params={**BOOSTED_PARAMS, "n_estimators": 25})
    auc = lambda df: roc_auc(df, "churned", "score").first()["auc"]
    assert abs(auc(test.withColumn("score", ours.score())) - auc(predict(theirs.model, test))) < 0.03
