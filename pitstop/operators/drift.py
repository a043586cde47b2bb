"""Population Stability Index drift.

Semantics per feature or group (expected = training sample, actual = live):
NULL/NaN values dropped; edges = the exact quantiles (linear interpolation, as
``numpy.quantile``) at ``linspace(0, 1, buckets + 1)``, deduplicated; fewer
than 2 edges -> PSI 0; histogram on the edges with bins ``[e_i, e_{i+1})`` and
the last bin closed, out-of-range live values in no bin but in the live
denominator; fractions floored at 1e-4; ``PSI = sum((a - e) * ln(a / e))``;
verdict OK < 0.1 <= INVESTIGATE < 0.25 <= RETRAIN.  A group without expected
values (an empty sample, or one that only the live side has) gives NULL /
``NO_DATA``.  NULL is a group like any other.

Plan: the expected side is reduced to a profile, one row a group with its
edges and bin counts.  Live rows are joined with the profile on the group
(the planner broadcasts it while it is small), binned in place and counted per
bin by one partially aggregated groupBy, so a hot group never reaches one task
as raw rows.  Groups may be of any type and number.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from pitstop.functions.exprs import psi_verdict, sql_double
from pitstop.operators.ranking import value_blocks
from pitstop.session import scratch_path

EPS = 1e-4
DEFAULT_BUCKETS = 10


def quantile_probs(buckets: int = DEFAULT_BUCKETS) -> list[float]:
    """``numpy.linspace(0, 1, buckets + 1)`` bit for bit: i * (1 / buckets),
    last point exactly 1."""
    step = 1.0 / buckets
    return [i * step for i in range(buckets)] + [1.0]


def _clean(v: Column) -> Column:
    d = v.cast("double")
    return F.when(F.isnan(d), None).otherwise(d)


def unpivot_features(df: DataFrame, features: Sequence[str], group_col: str = "feature",
                     value_col: str = "value", keep: Sequence[str] = ()) -> DataFrame:
    """Wide -> long (group, value) with NULL/NaN dropped."""
    pairs = F.array(*[F.struct(F.lit(f).alias(group_col), _clean(F.col(f)).alias(value_col))
                      for f in features])
    return (df.select(*keep, F.explode(pairs).alias("_p"))
            .select(*keep, f"_p.{group_col}", f"_p.{value_col}")
            .where(F.col(value_col).isNotNull()))


def _long(df: DataFrame, group_col: str, value_col: str, by: Sequence[str] = ()) -> DataFrame:
    """(by..., _g, _v): the group in a struct, which makes NULL an ordinary key."""
    return (df.select(*by, F.struct(F.col(group_col).alias("g")).alias("_g"), _clean(F.col(value_col)).alias("_v"))
            .where(F.col("_v").isNotNull()))


def _quantiles(blocked: DataFrame, offsets: DataFrame, probs: Sequence[float]) -> DataFrame:
    """(_g, quantiles): an array in the order of ``probs``, by numpy's rule:
    position (n - 1) * q; ``a + (b - a) * g`` for g < 0.5 else ``b - (b - a) *
    (1 - g)``.  The offsets tell which blocks hold a needed rank (two ranks a
    quantile); only those are sorted and windowed."""
    qs = "array(" + ", ".join(f"named_struct('i', {i}, 'at', CAST(cnt_all - 1 AS DOUBLE) * {sql_double(q)})" for i, q in enumerate(probs)) + ")"
    ranks = (f"flatten(transform({qs}, x -> array(named_struct('i', x.i, 'at', x.at, 'low', true, 'rank', CAST(floor(x.at) AS BIGINT)), "
             "named_struct('i', x.i, 'at', x.at, 'low', false, 'rank', least(CAST(floor(x.at) AS BIGINT) + 1, cnt_all - 1)))))")
    need = (offsets.selectExpr("_g", "_blk", "cnt_off", f"filter({ranks}, x -> x.rank >= cnt_off AND x.rank < cnt_off + cnt_sum) AS _need")
            .where("size(_need) > 0"))
    earlier = Window.partitionBy("_g", "_blk").orderBy("_v").rowsBetween(Window.unboundedPreceding, -1)
    hits = (blocked.join(need, ["_g", "_blk"])
            .withColumn("_before", F.col("cnt_off") + F.coalesce(F.sum("cnt").over(earlier), F.lit(0)))
            .selectExpr("_g", "_v", "inline(filter(_need, x -> _before <= x.rank AND x.rank < _before + cnt))"))
    ends = hits.groupBy("_g").agg(F.collect_list(F.struct("i", "at", "low", "_v")).alias("_ends"))      # two a quantile
    one = "filter(_ends, x -> x.i = i AND {}x.low)[0]".format
    pairs = f"transform(sequence(0, {len(probs) - 1}), i -> named_struct('a', {one('')}._v, 'b', {one('NOT ')}._v, 'g', {one('')}.at - floor({one('')}.at)))"
    value = "transform(_pairs, p -> IF(p.g >= 0.5D, p.b - (p.b - p.a) * (1 - p.g), p.a + (p.b - p.a) * p.g))"
    return ends.selectExpr("_g", f"{pairs} AS _pairs").selectExpr("_g", f"{value} AS quantiles")


def _blocks(long_df: DataFrame, num_blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Distinct values with counts in ordered blocks; repeated values are
    folded by partial aggregation first."""
    counted = long_df.groupBy("_g", "_v").agg(F.count(F.lit(1)).alias("cnt"))
    return value_blocks(counted, ["_g"], "_v", ["cnt"], num_blocks=num_blocks)


def exact_quantiles(long_df: DataFrame, group_col: str, value_col: str,
                    probs: Sequence[float], num_blocks: int | None = None) -> DataFrame:
    """Exact linear-interpolated quantiles per group -> (group, q_idx, quantile),
    bit-equal to ``numpy.quantile`` with the default method."""
    q = _quantiles(*_blocks(_long(long_df, group_col, value_col), num_blocks), probs)
    return q.select(F.col("_g.g").alias(group_col), F.posexplode("quantiles").alias("q_idx", "quantile"))


def tallies(buckets: int, weight: str = "1L") -> list[Column]:
    """Aggregates over (_v, edges): what lies at or above each edge, and on the
    last one.  Plain comparisons, so they stay in generated code; differences
    of neighbours are the bin counts (:func:`bins`)."""
    def where(condition: str, name: str) -> Column:
        return F.expr(f"coalesce(sum(CASE WHEN {condition} THEN {weight} END), 0L) AS {name}")
    return [*[where(f"_v >= get(edges, {k})", f"_n{k}") for k in range(buckets + 1)],
            where("_v = get(edges, size(edges) - 1)", "_top")]


def tally_names(buckets: int) -> list[str]:
    return [*[f"_n{k}" for k in range(buckets + 1)], "_top"]


def bins(buckets: int) -> Column:
    """Bin counts from the columns of :func:`tallies` and edges; none without two edges."""
    n = "array(" + ", ".join(f"_n{k}" for k in range(buckets + 1)) + ")"
    return F.expr(f"CASE WHEN size(edges) >= 2 THEN transform(slice({n}, 1, size(edges) - 1), (x, i) -> "
                  f"x - get({n}, i + 1) + IF(i = size(edges) - 2, _top, 0L)) ELSE CAST(array() AS array<bigint>) END")


def expected_profile(expected_long: DataFrame, group_col: str, value_col: str,
                     buckets: int = DEFAULT_BUCKETS, edge_digits: int | None = None) -> DataFrame:
    """Per group: (group, edges, n_expected, e_counts), written to the shared
    folder.  The expected side is read once: its distinct values give both the
    quantiles and the bin counts."""
    spark = expected_long.sparkSession
    blocked, offsets = _blocks(_long(expected_long, group_col, value_col))
    value = f"transform(quantiles, x -> round(x, {edge_digits}))" if edge_digits is not None else "quantiles"
    edges = _quantiles(blocked, offsets, quantile_probs(buckets)).selectExpr("_g", f"sort_array(array_distinct({value})) AS edges")
    counts = (blocked.join(edges, "_g").groupBy("_g")
              .agg(F.sum("cnt").alias("n_expected"), F.first("edges").alias("edges"), *tallies(buckets, "cnt")))
    profile = counts.select(F.col("_g.g").alias(group_col), "edges", "n_expected", bins(buckets).alias("e_counts"))
    path = scratch_path(spark, "profile")
    profile.write.parquet(path)
    return spark.read.schema(profile.schema).parquet(path)


def _psi(eps: float = EPS) -> Column:
    """PSI of the columns e_counts, n_expected, a_counts, n_actual (bins summed left to right)."""
    terms = (f"zip_with(e_counts, a_counts, (e, a) -> named_struct('pe', greatest(e / n_expected, {eps!r}D), "
             f"'pa', greatest(a / greatest(n_actual, 1), {eps!r}D)))")
    total = f"aggregate({terms}, 0D, (acc, t) -> acc + (t.pa - t.pe) * ln(t.pa / t.pe))"
    return F.expr(f"CASE WHEN n_expected IS NULL OR n_expected = 0 THEN CAST(NULL AS DOUBLE) "
                  f"WHEN size(e_counts) < 1 THEN 0D ELSE {total} END")


def _known(profile: DataFrame, group_col: str) -> DataFrame:
    return profile.select(F.struct(F.col(group_col).alias("g")).alias("_g"), "edges", "n_expected", "e_counts")


def live_tallies(live: DataFrame, profile: DataFrame, group_col: str, by: Sequence, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """(by..., _g, n_actual and the tallies) of ``live`` rows (by..., _g, _v)
    on the edges of a profile; batch or streaming.  Tallies of parts add up."""
    edges = _known(profile, group_col).select("_g", "edges")
    return live.join(edges, "_g", "left").groupBy(*by, "_g").agg(F.count("_v").alias("n_actual"), *tallies(buckets))


def against_profile(tallied: DataFrame, profile: DataFrame, group_col: str, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """The rows of :func:`live_tallies` with group, n_out_of_range, a_counts,
    edges, n_expected, e_counts.  Groups that the profile does not have keep
    NULL for its columns."""
    names = [c for c in tallied.columns if c not in ("_g", "n_actual", *tally_names(buckets))]
    return (tallied.join(_known(profile, group_col), "_g", "left").withColumn("a_counts", bins(buckets))
            .select(*names, F.col("_g.g").alias(group_col), "n_actual",
                    F.expr("n_actual - aggregate(a_counts, 0L, (a, x) -> a + x)").alias("n_out_of_range"),
                    "a_counts", "edges", "n_expected", "e_counts"))


def bin_counts(live: DataFrame, profile: DataFrame, group_col: str, by: Sequence, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    return against_profile(live_tallies(live, profile, group_col, by, buckets), profile, group_col, buckets)


def grouped_psi(actual_long: DataFrame, profile: DataFrame, group_col: str, value_col: str,
                by: Sequence[str] = (), buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """(by..., group, n_actual, n_out_of_range, psi, verdict) of live values
    against a profile from :func:`expected_profile`; every live group has a row."""
    counts = bin_counts(_long(actual_long, group_col, value_col, by), profile, group_col, by, buckets)
    return (counts.select(*by, group_col, "n_actual", "n_out_of_range", _psi().alias("psi"))
            .withColumn("verdict", psi_verdict(F.col("psi"))))


# ------------------------------------------------------------ wide tables


def edges_table(expected: DataFrame, features: Sequence[str], buckets: int = DEFAULT_BUCKETS,
                edge_digits: int | None = None) -> DataFrame:
    """(feature, edges array<double> sorted distinct) from the expected side."""
    return (expected_profile(unpivot_features(expected, features), "feature", "value", buckets, edge_digits)
            .select("feature", "edges"))


def drift_counts(expected: DataFrame, actual: DataFrame, features: Sequence[str],
                 buckets: int = DEFAULT_BUCKETS, edge_digits: int | None = None) -> DataFrame:
    """A row for each of ``features``, with or without values on either side:
    (feature, edges, n_expected, e_counts, n_actual, n_out_of_range, a_counts)."""
    profile = expected_profile(unpivot_features(expected, features), "feature", "value", buckets, edge_digits)
    live = live_tallies(_long(unpivot_features(actual, features), "feature", "value"), profile, "feature", (), buckets)
    tallied = live.select(F.col("_g.g").alias("feature"), "n_actual", *tally_names(buckets))
    names = expected.sparkSession.range(1).select(F.explode(F.array(*[F.lit(f) for f in features])).alias("feature"))
    none = F.array().cast("array<bigint>")
    counted = (names.join(profile, "feature", "left").join(tallied, "feature", "left")
               .select("feature", F.coalesce("edges", F.array().cast("array<double>")).alias("edges"), F.coalesce("e_counts", none).alias("e_counts"),
                       *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("n_expected", "n_actual", *tally_names(buckets))])
               .withColumn("a_counts", bins(buckets)))
    return counted.select("feature", "edges", "n_expected", "e_counts", "n_actual",
                          F.expr("n_actual - aggregate(a_counts, 0L, (a, x) -> a + x)").alias("n_out_of_range"), "a_counts")


def psi_report(expected: DataFrame, actual: DataFrame, features: Sequence[str],
               buckets: int = DEFAULT_BUCKETS, edge_digits: int | None = None) -> DataFrame:
    """(feature, psi, verdict, n_expected, n_actual, n_out_of_range, n_bins)
    for the features present in both frames."""
    feats = [f for f in features if f in expected.columns and f in actual.columns]
    return (drift_counts(expected, actual, feats, buckets, edge_digits)
            .select("feature", _psi().alias("psi"), "n_expected", "n_actual", "n_out_of_range",
                    F.size("e_counts").cast("long").alias("n_bins"))
            .select("feature", "psi", psi_verdict(F.col("psi")).alias("verdict"), "n_expected", "n_actual",
                    "n_out_of_range", "n_bins"))


def psi_histogram(expected: DataFrame, actual: DataFrame, features: Sequence[str],
                  buckets: int = DEFAULT_BUCKETS, edge_digits: int | None = None) -> DataFrame:
    """(feature, side, bin, lower, upper, n) for every bin of both sides."""
    feats = [f for f in features if f in expected.columns and f in actual.columns]
    sides = F.array(*[F.struct(F.lit(side).alias("side"), F.col(c).alias("counts"))
                      for side, c in (("expected", "e_counts"), ("actual", "a_counts"))])
    return (drift_counts(expected, actual, feats, buckets, edge_digits)
            .select("feature", "edges", F.explode(sides).alias("s"))
            .select("feature", "edges", "s.side", F.posexplode("s.counts").alias("bin", "n"))
            .select("feature", "side", F.col("bin").cast("long").alias("bin"), F.expr("edges[bin]").alias("lower"),
                    F.expr("edges[bin + 1]").alias("upper"), "n"))


def psi_value(expected: Sequence[float], actual: Sequence[float], buckets: int = DEFAULT_BUCKETS,
              spark=None) -> float | None:
    """Convenience for small in-memory samples (tests, notebooks)."""
    def frame(xs):
        return spark.createDataFrame([(None if x is None else float(x),) for x in xs], "x double")
    r = psi_report(frame(expected), frame(actual), ["x"], buckets).collect()[0]
    return None if r["psi"] is None else float(r["psi"])
