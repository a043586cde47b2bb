import math
import random
from collections import Counter

import numpy as np
import pytest

from pitstop.llm import bidiagonal, whitening

SCHEMA = "vec_id long, embedding array<float>, label int"


def triangle(a):
    r = np.linalg.qr(np.asarray(a, float), mode="r")
    return np.vstack([r, np.zeros((max(0, r.shape[1] - r.shape[0]), r.shape[1]))])


def matrices():
    rng = np.random.default_rng(5)
    turn = lambda n: np.linalg.qr(rng.standard_normal((n, n)))[0]
    return {"random": rng.standard_normal((300, 64)), "wide": rng.standard_normal((10, 40)),
            "falling": rng.standard_normal((90, 30)) * 10.0 ** -np.arange(30), "rising": rng.standard_normal((90, 30)) * 10.0 ** np.arange(-30, 0),
            "identity": np.eye(20), "clusters": turn(40) @ np.diag([5.0] * 8 + [5.0 - 1e-9] * 4 + [3.0] * 10 + [1.0] * 18) @ turn(40),
            "near": turn(30) @ np.diag([2 + 1e-6 * i for i in range(30)]) @ turn(30), "rank 1": np.outer(np.arange(1, 30), np.arange(2, 22)),
            "rank 3": rng.standard_normal((50, 3)) @ rng.standard_normal((3, 25)), "zero": np.zeros((4, 7)), "one": [[3.0], [4.0]],
            "diagonal": np.diag(np.arange(12.0)), "huge": rng.standard_normal((50, 10)) * 1e150, "tiny": rng.standard_normal((50, 10)) * 1e-120}


@pytest.mark.parametrize("name", list(matrices()))
def test_values_and_directions(name):
    r = triangle(matrices()[name])
    k = min(16, r.shape[1])
    values, v = bidiagonal.right_directions(r, k)
    want = np.linalg.svd(r, compute_uv=False)
    top = max(want[0], 1e-300)
    assert np.abs(values - want).max() <= 1e-13 * top
    kept = values[:k] > 1e-13 * top
    v, s = v[:, kept], values[:k][kept]
    assert np.abs(v.T @ v - np.eye(len(s))).max(initial=0) < 1e-9
    assert np.linalg.norm((r / top).T @ (r / top @ v) - v * (s / top) ** 2, axis=0).max(initial=0) < 1e-9


def test_dqds_is_right_in_small_values_too():
    d, e = 10.0 ** -np.arange(0, 40, 2), 0.3 * 10.0 ** -np.arange(0, 38, 2)
    values = bidiagonal.dqds(d, e)
    assert math.prod(values) == pytest.approx(math.prod(d), rel=1e-12) and (np.diff(values) <= 0).all()


def whole(v):
    if v is None or any(c is None or not math.isfinite(c) for c in v):
        return None
    return tuple(math.floor(64 * float(np.float32(c))) + 1_000_000 for c in v)


def brute(rows, components=16):
    kept = [(i, whole(v)) for i, v, _ in rows if whole(v) is not None]
    dims = max((len(x) for _, x in kept), default=0)
    kept = [(i, x + (1_000_000,) * (dims - len(x))) for i, x in kept]
    fit = sorted({x for _, x in kept})
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    a = np.array([[float(n * x - s) / n for x, s in zip(row, sums)] for row in fit])
    values, vectors = np.linalg.eigh(a.T @ a / n)
    return kept, n, sums, values[::-1][:components], vectors[:, ::-1][:, :components], values.sum()


def check(got, rows):
    kept, n, sums, e, v, trace = brute(rows)
    k = int((e > 1e-12 * e[0]).sum())
    assert len(got) == len(kept) * k
    want = Counter()
    for i, x in kept:
        want[i, sum((n * c - s) ** 2 for c, s in zip(x, sums))] += 1
    assert Counter((r.vec_id, r.deviation) for r in got if r.component == 1) == want
    assert {r.n for r in got} == {n} and {r.identity_error < 1e-9 for r in got} == {True}
    assert {(r.component, round(r.explained, 10)) for r in got} == {(j + 1, round(e[j] / trace, 10)) for j in range(k)}
    by_id = {}
    for i, x in kept:
        by_id.setdefault(i, []).append((np.array([float(n * c - s) / n for c, s in zip(x, sums)]) @ v[:, :k]) / np.sqrt(e[:k]))
    sign = {}
    for r in got:
        if len(by_id[r.vec_id]) == 1:
            w = by_id[r.vec_id][0][r.component - 1]
            if abs(w) > 1e-3:
                assert abs(abs(r.whitened) - abs(w)) < 1e-6 * max(1, abs(w))
                assert sign.setdefault(r.component, r.whitened * w > 0) == (r.whitened * w > 0)


def vectors(n, dims, seed=2):
    rng = random.Random(seed)
    return [(i, [rng.gauss(0, 1 + d / 4) for d in range(dims)], i % 3) for i in range(n)]


def frame(spark, rows, parts=5):
    return spark.createDataFrame(rows, SCHEMA).selectExpr("*", "cast(1 as int) as component", "'x' as x", "1 as dims").repartition(parts)


@pytest.mark.parametrize("dims", [24, 5])
def test_whitening(spark, dims, monkeypatch):
    monkeypatch.setattr(whitening, "FACTORS", 2)             # several rounds
    monkeypatch.setattr(whitening, "BLOCK_ROWS", 7)
    rows = vectors(120, dims)
    rows += [(200 + i, rows[3][1], None) for i in range(70)]                       # a group of copies
    rows += [(300, None, 1), (301, [None] + [0.0] * (dims - 1), 1), (302, [float("nan")] * dims, 1),
             (303, [float("inf")] + [0.0] * (dims - 1), 1), (None, [0.5] * dims, 1), (304, [-0.001] * dims, 1), (7, rows[9][1], 1)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)


def test_lengths_and_sizes(spark):
    rows = vectors(40, 6) + [(50, [1.0, 2.0], 0), (51, [1.0, 2.0, 0.0], 0), (52, [], 0), (53, [600.0] * 6, 0), (54, [2.0**14] * 3, 0)]
    check(whitening.whiten(frame(spark, rows)).collect(), rows)
    huge = whitening.whiten(frame(spark, vectors(9, 3) + [(60, [3e38, 1.0, 1.0], 0)])).filter("vec_id = 60").collect()
    assert huge and {r.deviation for r in huge} == {None}


def test_nothing_to_whiten(spark):
    for rows in ([], [(1, None, 0)], [(1, [], 0), (2, [], 0)], [(1, [1.0, 2.0], 0)] * 4):
        assert whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect() == []
