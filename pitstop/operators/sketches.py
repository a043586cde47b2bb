"""Mergeable sketches, where an exact answer would have to read history again.

Opt-in: the exact forms stay the default.  Distinct products are HyperLogLog
sketches by (key, first cutoff), so that many cutoffs, and later ones, merge
sketches instead of counting pairs anew.  Quantiles for drift are KLL sketches
by (day, group): the profile of any range of days is a merge of its days."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitstop.functions.exprs import count_below, sql_double
from pitstop.operators.drift import DEFAULT_BUCKETS, _clean, quantile_probs
from pitstop.operators.features import _cutoff_list

LG_K = 12                     # 4,096 registers: a relative standard error of 1.04 / 64
KLL_K = 400
GRID = 1000                   # quantiles that a profile's counts are read from


def relative_error(lg_k: int = LG_K) -> float:
    """Relative standard error of a distinct count."""
    return 1.04 / 2 ** (lg_k / 2)


# -------------------------------------------------------- distinct products


def product_sketches(orders: DataFrame, items: DataFrame, cutoffs: Iterable, keys: Sequence[str] = ("customer_id",),
                     lg_k: int = LG_K) -> DataFrame:
    """(keys..., idx, sketch): the products that a key's orders bring in up to
    cutoff idx and after the one before.  Orders without a date or beyond the
    last cutoff, and items without a product, count nowhere.  One join on
    order_id and one partially aggregated groupBy; a hot key's rows become a
    sketch before they are shuffled."""
    cs = _cutoff_list(cutoffs)
    midnights = [F.lit(c).cast("timestamp_ntz") for c in cs]
    dated = (orders.where(F.col("order_date").isNotNull() & (F.col("order_date") <= midnights[-1]))
             .select("order_id", *keys, count_below(F.col("order_date"), midnights).alias("idx")))
    pairs = dated.join(items.where(F.col("product_id").isNotNull()).select("order_id", F.col("product_id").cast("long")), "order_id")
    return pairs.groupBy(*keys, "idx").agg(F.hll_sketch_agg("product_id", lg_k).alias("sketch"))


def merged_counts(sketches: DataFrame, cutoffs: Iterable, keys: Sequence[str] = ("customer_id",)) -> DataFrame:
    """(cutoff_date, keys..., distinct_products): estimates at each cutoff from
    which a key has products.  A key's few sketches are merged in order, each
    once, with a running union."""
    cs = _cutoff_list(cutoffs)
    line = sketches.groupBy(*keys).agg(F.sort_array(F.collect_list(F.struct("idx", "sketch"))).alias("_line"))   # one a cutoff
    start = "CAST(named_struct('sofar', NULL, 'out', array()) AS struct<sofar:binary,out:array<struct<idx:int,n:bigint>>>)"
    union = "CASE WHEN a.sofar IS NULL THEN e.sketch ELSE hll_union(a.sofar, e.sketch) END"
    step = (f"named_struct('sofar', {union}, 'out', concat(a.out, array(named_struct("
            f"'idx', CAST(e.idx AS INT), 'n', hll_sketch_estimate({union})))))")
    counts = line.select(*keys, F.expr(f"aggregate(_line, {start}, (a, e) -> CAST({step} AS "
                                       "struct<sofar:binary,out:array<struct<idx:int,n:bigint>>>)).out").alias("_n"))
    dates = F.array(*[F.lit(c) for c in cs])
    each = counts.select(*keys, "_n", F.posexplode(dates).alias("_k", "cutoff_date"))
    latest = F.expr("get(reverse(filter(_n, x -> x.idx <= _k)), 0).n")
    return each.select("cutoff_date", *keys, latest.alias("distinct_products")).where("distinct_products IS NOT NULL")


def approx_past_products(orders: DataFrame, items: DataFrame, cutoffs: Iterable, keys: Sequence[str] = ("customer_id",),
                         lg_k: int = LG_K) -> DataFrame:
    """Estimated distinct products of the past orders, for all cutoffs at once."""
    return merged_counts(product_sketches(orders, items, cutoffs, keys, lg_k), cutoffs, keys)


# ---------------------------------------------------------- drift profiles


def daily_sketches(rows: DataFrame, group_col: str, value_col: str, ts_col: str, k: int = KLL_K) -> DataFrame:
    """(day, group, sketch) of the values; NULL and NaN values are dropped, NULL
    is a group.  Append each day's rows to a table and profile any range."""
    return (rows.select(F.to_date(ts_col).alias("day"), F.col(group_col), _clean(F.col(value_col)).alias("_v"))
            .where("_v IS NOT NULL AND day IS NOT NULL")
            .groupBy("day", group_col).agg(F.expr(f"kll_sketch_agg_double(_v, {k})").alias("sketch")))


def range_sketches(sketches: DataFrame, group_col: str, first_day, last_day) -> DataFrame:
    """(group, sketch, n) of the days from first to last."""
    inside = sketches.where(F.col("day").between(F.lit(first_day), F.lit(last_day)))
    return (inside.groupBy(group_col).agg(F.expr("kll_merge_agg_double(sketch)").alias("sketch"))
            .withColumn("n", F.expr("kll_sketch_get_n_double(sketch)")))


def sketch_quantiles(sketch: str, probs: Sequence[float]) -> Column:
    return F.expr(f"kll_sketch_get_quantile_double({sketch}, array({', '.join(map(sql_double, probs))}))")


def sketch_profile(sketches: DataFrame, group_col: str, first_day, last_day, buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """A profile (group, edges, n_expected, e_counts) for
    :func:`pitstop.operators.drift.grouped_psi` from the sketches of a range of
    days: its edges are quantiles of the sketch, its counts the shares of a
    grid of quantiles between them.  Least and greatest edge are exact."""
    merged = range_sketches(sketches, group_col, first_day, last_day)
    edges = F.array_sort(F.array_distinct(sketch_quantiles("sketch", quantile_probs(buckets))))
    # The share before an edge is that of a fine grid of quantiles that lie below it, ties and all.
    grid = sketch_quantiles("sketch", [(k + 0.5) / GRID for k in range(GRID)])
    below = f"transform(edges, e -> size(filter(_grid, x -> x < e)) / {float(GRID)}D)"
    counts = ("CASE WHEN size(edges) < 2 THEN CAST(array() AS array<bigint>) ELSE transform(sequence(0, size(edges) - 2), i -> "
              "CAST(round(n * (IF(i = size(edges) - 2, 1D, _below[i + 1]) - _below[i])) AS BIGINT)) END")
    return (merged.withColumn("edges", edges).withColumn("_grid", grid).withColumn("_below", F.expr(below))
            .select(group_col, "edges", F.col("n").alias("n_expected"), F.expr(counts).alias("e_counts")))
