"""Gradient boosting with second-order histogram trees and Newton leaves.

Features are cut into bins by their exact quantiles.  A level of a tree is one
aggregate: gradient, hessian and row count by (node, feature, bin), partially
aggregated, of which at most nodes x features x bins rows reach the driver.  A
split maximises GL^2/HL + GR^2/HR - G^2/H; a leaf moves by -rate * G/H.

Gradients and hessians are summed as whole numbers (``UNIT`` parts), so a tree
does not depend on the order that rows are added in.  Rows are written once as
(label, bins, margin) and rewritten with their margin every ``restage`` trees;
in between the margin is an expression over the new trees."""

from __future__ import annotations

import math
from collections import defaultdict
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.functions.exprs import count_below, sql_double
from pitstop.operators.drift import exact_quantiles, unpivot_features
from pitstop.session import scratch_path
from pitstop.sources.schemas import FEATURE_COLUMNS, LABEL_COLUMN

UNIT = 1 << 24
TREES, DEPTH, RATE = 200, 3, 0.1       # fixed values: the settings of the boosted model
MAX_BINS = 32


@dataclass
class Tree:
    """Nodes are numbered from 1; node i has the children 2i and 2i + 1."""
    splits: dict[int, tuple[int, int]] = field(default_factory=dict)     # node -> feature, last bin that goes left
    leaves: dict[int, float] = field(default_factory=dict)

    def sql(self, goes_left, node: int = 1) -> str:
        if node in self.leaves:
            return sql_double(self.leaves[node])
        return (f"CASE WHEN {goes_left(*self.splits[node])} THEN {self.sql(goes_left, 2 * node)} "
                f"ELSE {self.sql(goes_left, 2 * node + 1)} END")


@dataclass
class Boosted:
    features: list[str]
    edges: list[list[float]]      # bin = number of edges at or below the value
    prior: float                  # log odds
    trees: list[Tree]

    def margin(self) -> Column:
        """Log odds of a row with the raw features: the trees added up in their order."""
        def goes_left(f: int, b: int) -> str:
            return f"CAST({self.features[f]} AS DOUBLE) < {sql_double(self.edges[f][b])}"
        if not self.trees:
            return F.expr(sql_double(self.prior))
        return F.expr(f"aggregate(array({', '.join(t.sql(goes_left) for t in self.trees)}), {sql_double(self.prior)}, (a, x) -> a + x)")

    def score(self) -> Column:
        return 1.0 / (1.0 + F.exp(-self.margin()))

    def table(self, spark: SparkSession) -> DataFrame:
        """(tree, node, feature, threshold, weight): splits send values below
        the threshold to node 2i; leaves have a weight."""
        rows = []
        for t, tree in enumerate(self.trees):
            rows += [(t, n, self.features[f], float(self.edges[f][b]), None) for n, (f, b) in tree.splits.items()]
            rows += [(t, n, None, None, float(w)) for n, w in tree.leaves.items()]
        return spark.createDataFrame(rows, "tree long, node long, feature string, threshold double, weight double")


def bin_edges(rows: DataFrame, features: Sequence[str], max_bins: int = MAX_BINS, edge_digits: int | None = None) -> list[list[float]]:
    """Inner edges of each feature's bins: exact quantiles, each once.  At most
    features x (max_bins - 1) numbers reach the driver."""
    cuts = exact_quantiles(unpivot_features(rows, features), "feature", "value", [k / max_bins for k in range(1, max_bins)])
    value = F.round("quantile", edge_digits) if edge_digits is not None else F.col("quantile")
    found = defaultdict(set)
    for r in cuts.select("feature", value.alias("edge")).distinct().collect():
        found[r["feature"]].add(float(r["edge"]))
    return [sorted(found[f]) for f in features]


def best_split(hist: dict[tuple[int, int], tuple[int, int, int]], min_rows: int) -> tuple[int, int, int, int, int, int] | None:
    """(feature, bin, GL, HL, GR, HR) of the largest gain over {(feature, bin):
    (G, H, rows)} of a node; the first feature, then the first bin, of equal ones."""
    best, gain = None, 0.0
    for f in sorted({f for f, _ in hist}):
        line = sorted((b, v) for (g, b), v in hist.items() if g == f)
        total = [sum(v[k] for _, v in line) for k in range(3)]
        left = [0, 0, 0]
        for b, v in line[:-1]:
            left = [x + y for x, y in zip(left, v)]
            right = [x - y for x, y in zip(total, left)]
            if min(left[2], right[2]) < min_rows:
                continue
            found = _value(*left[:2]) + _value(*right[:2]) - _value(*total[:2])
            if found > gain:
                best, gain = (f, b, *left[:2], *right[:2]), found
    return best


def _value(g: int, h: int) -> float:
    return float(g) * float(g) / float(max(h, 1))


def fit_boosted(rows: DataFrame, features: Sequence[str] = FEATURE_COLUMNS, label: str = LABEL_COLUMN, trees: int = TREES,
                depth: int = DEPTH, rate: float = RATE, max_bins: int = MAX_BINS, min_rows: int = 1, restage: int = 10,
                edge_digits: int | None = None) -> Boosted:
    """Fit on the rows without a NULL in features or label (0 or 1).

    No rows raise ValueError; rows of one class, or of one value in every
    feature, give a model without splits (the prior, infinite for one class).
    A node without a split of positive gain stays a leaf."""
    spark = rows.sparkSession
    known = rows.dropna(subset=[*features, label])
    n, ones = known.agg(F.count(F.lit(1)), F.sum(F.col(label).cast("long"))).first()
    if not n:
        raise ValueError("no rows to fit")
    if ones in (0, n):
        return Boosted(list(features), [[] for _ in features], math.inf if ones else -math.inf, [])
    model = Boosted(list(features), bin_edges(known, features, max_bins, edge_digits), math.log(ones / (n - ones)), [])

    def staged(df: DataFrame) -> DataFrame:
        path = scratch_path(spark, "boosting")
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)

    coded = staged(known.select(
        F.col(label).cast("int").alias("_y"), F.lit(model.prior).alias("_m"),
        *[count_below(F.col(f).cast("double"), e, strict=False).cast("smallint").alias(f"_b{k}")
          for k, (f, e) in enumerate(zip(features, model.edges))]))
    pending: list[Tree] = []

    def in_bins(f: int, b: int) -> str:
        return f"_b{f} <= {b}"

    def margin() -> str:
        return " + ".join(["_m", *[t.sql(in_bins) for t in pending]])

    for _ in range(trees):
        parts = (coded.selectExpr("*", f"1D / (1D + exp(-({margin()}))) AS _p")
                 .selectExpr("*", f"CAST(floor((_p - _y) * {UNIT}D + 0.5D) AS BIGINT) AS _g",
                             f"CAST(floor(_p * (1D - _p) * {UNIT}D + 0.5D) AS BIGINT) AS _h"))
        tree, open_nodes = Tree(), {1: None}
        for level in range(depth + 1):
            for node, sums in open_nodes.items():
                if sums is not None and (level == depth or sums[1] == 0):
                    tree.leaves[node] = -(float(sums[0]) / float(max(sums[1], 1))) * rate
            open_nodes = {k: v for k, v in open_nodes.items() if k not in tree.leaves}
            if level == depth or not open_nodes:
                break
            hists = _histograms(parts, tree, open_nodes, len(features))
            following = {}
            for node, hist in sorted(hists.items()):
                found = best_split(hist, min_rows)
                if found is None:
                    g, h = (sum(v[k] for (f, _), v in hist.items() if f == 0) for k in (0, 1))
                    tree.leaves[node] = -(float(g) / float(max(h, 1))) * rate
                else:
                    tree.splits[node] = found[:2]
                    following |= {2 * node: found[2:4], 2 * node + 1: found[4:6]}
            open_nodes = following
        model.trees.append(tree)
        pending.append(tree)
        if len(pending) == restage:
            coded = staged(coded.withColumn("_m", F.expr(margin())))
            pending = []
    return model


def _histograms(parts: DataFrame, tree: Tree, open_nodes, n_features: int) -> dict[int, dict[tuple[int, int], tuple[int, int, int]]]:
    """{node: {(feature, bin): (G, H, rows)}} of the open nodes, in one aggregate."""
    def place(node: int) -> str:
        if node not in tree.splits:
            return str(node)
        f, b = tree.splits[node]
        return f"CASE WHEN _b{f} <= {b} THEN {place(2 * node)} ELSE {place(2 * node + 1)} END"

    pairs = ", ".join(f"named_struct('f', {f}, 'b', CAST(_b{f} AS INT))" for f in range(n_features))
    sums = (parts.selectExpr(f"{place(1)} AS _node", "_g", "_h", f"array({pairs}) AS _pairs")
            .where(F.col("_node").isin(*open_nodes)).selectExpr("_node", "_g", "_h", "inline(_pairs)")
            .groupBy("_node", "f", "b").agg(F.sum("_g").alias("g"), F.sum("_h").alias("h"), F.count(F.lit(1)).alias("c")))
    out: dict = defaultdict(dict)
    for r in sums.collect():
        out[r["_node"]][r["f"], r["b"]] = r["g"], r["h"], r["c"]
    return out
