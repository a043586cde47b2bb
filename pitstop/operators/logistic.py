"""L2 logistic regression by Newton's method, with a checkable optimum.

Features are centred and divided by their sample standard deviation.  The
objective is the summed log-loss plus ``|w|^2 / (2 C)``, the intercept free.
Each step is one aggregate over the rows, whatever their number: the sums of
X'WX, X'(y - p) and the loss, a row of (k + 1)(k + 4) / 2 + 1 numbers for k
features; the (k + 1) x (k + 1) system is solved on the driver.  A step that
does not lower the loss is halved, so the method also holds where plain Newton
would overshoot."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.functions.exprs import sql_double
from pitstop.sources.schemas import FEATURE_COLUMNS, LABEL_COLUMN

INTERCEPT = "intercept"


@dataclass
class Logistic:
    features: list[str]
    mean: list[float]
    scale: list[float]
    weights: list[float]          # of the scaled features
    intercept: float
    gradient: list[float]         # of the objective at the weights, intercept first
    objective: float
    steps: int
    n: int

    def _scaled(self) -> list[str]:
        return [f"(CAST({f} AS DOUBLE) - {sql_double(m)}) / {sql_double(s)}" if s else "0D"
                for f, m, s in zip(self.features, self.mean, self.scale)]

    def score(self) -> Column:
        """P(class 1) of a row with the raw features."""
        terms = " + ".join(f"{sql_double(w)} * ({z})" for w, z in zip(self.weights, self._scaled()))
        return F.expr(f"1D / (1D + exp(-({sql_double(self.intercept)} + {terms})))")

    def table(self, spark: SparkSession) -> DataFrame:
        """(term, weight, gradient), the intercept first."""
        rows = list(zip([INTERCEPT, *self.features], [self.intercept, *self.weights], self.gradient))
        return spark.createDataFrame([(t, float(w), float(g)) for t, w, g in rows], "term string, weight double, gradient double")


def _sums(rows: DataFrame, model: Logistic, label: str) -> tuple[np.ndarray, np.ndarray, float]:
    """(X'WX, X'(y - p), log-loss) at the model's weights."""
    k = len(model.features) + 1
    x = ["1D", *[f"_z{j}" for j in range(k - 1)]]
    weights = [model.intercept, *model.weights]
    linear = " + ".join(f"{sql_double(w)} * {z}" for w, z in zip(weights, x))
    at = (rows.selectExpr(f"CAST({label} AS DOUBLE) AS _y", *[f"{z} AS _z{j}" for j, z in enumerate(model._scaled())])
          .selectExpr("*", f"{linear} AS _t").selectExpr("*", "1D / (1D + exp(-_t)) AS _p"))
    pairs = [(i, j) for i in range(k) for j in range(i, k)]
    row = at.agg(*[F.expr(f"sum(_p * (1D - _p) * {x[i]} * {x[j]})") for i, j in pairs],
                 *[F.expr(f"sum((_y - _p) * {z})") for z in x],
                 F.expr("sum(greatest(_t, 0D) + log1p(exp(-abs(_t))) - _y * _t)")).first()
    values = [float(v or 0.0) for v in row]
    h = np.zeros((k, k))
    for (i, j), v in zip(pairs, values):
        h[i, j] = h[j, i] = v
    return h, np.array(values[len(pairs):-1]), values[-1]


def fit_logistic(rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = LABEL_COLUMN, c: float = 1.0,
                 max_steps: int = 50, tolerance: float = 1e-11) -> Logistic:
    """Fit on the rows without a NULL in features or label (0 or 1).  Reads the
    rows once for the scaling and once a step (about six), so give it a table.

    A constant feature has weight 0.  Rows of one class only have no finite
    intercept: it is infinite, all weights 0.  No rows raise ValueError."""
    known = rows.dropna(subset=[*features, label]).select(*features, label)
    stats = known.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long")),
                      *[F.avg(F.col(f).cast("double")) for f in features],
                      *[F.stddev_samp(F.col(f).cast("double")) for f in features]).first()
    n, ones, k = stats[0], stats[1], len(features)
    if not n:
        raise ValueError("no rows to fit")
    mean, scale = [float(v) for v in stats[2:2 + k]], [float(v or 0.0) for v in stats[2 + k:]]
    scale = [s if math.isfinite(s) else 0.0 for s in scale]
    model = Logistic(list(features), mean, scale, [0.0] * k, 0.0, [0.0] * (k + 1), 0.0, 0, n)
    if ones in (0, n):
        model.intercept = math.inf if ones else -math.inf
        return model
    penalty = np.array([0.0, *[1.0 / c] * k])

    def at(w: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
        model.intercept, model.weights = float(w[0]), [float(v) for v in w[1:]]
        h, g, loss = _sums(known, model, label)
        return h + np.diag(penalty), g - penalty * w, loss + float((penalty * w * w).sum()) / 2

    w = np.zeros(k + 1)
    h, g, objective = at(w)
    for step in range(1, max_steps + 1):
        move = np.linalg.solve(h, g)
        model.steps = step
        while True:
            h, g, new = at(w + move)
            if new <= objective + 1e-12 * abs(objective) or np.abs(move).max() < tolerance:
                break
            move /= 2
        w, objective = w + move, new
        if np.abs(move).max() <= tolerance * (1 + np.abs(w).max()):
            break
    model.gradient, model.objective = (-g).tolist(), objective
    return model
