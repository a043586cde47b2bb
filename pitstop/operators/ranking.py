"""Exact running totals over a global order without a single-partition window.

``value_blocks`` range-partitions the rows into ordered blocks and writes that
layout to the shared folder (so block ids stay fixed if tasks run again), then
sums each block (a table of blocks x groups rows) and turns the sums into
offsets.  ``running_totals`` finishes with a window inside each block; callers
that need a few ranks only, such as the quantiles, window just the blocks that
hold them.  The input rows are unique per (group, order value), so no block
grows with a frequent value.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitstop.session import scratch_path


def value_blocks(df: DataFrame, group_cols: Sequence[str], order_col: str, weight_cols: Sequence[str],
                 ascending: bool = True, num_blocks: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(rows with their ordered block ``_blk``, offsets): offsets has a row per
    (group, block) with ``<w>_sum`` of the block, ``<w>_off`` of the group's
    blocks before it and ``<w>_all`` of the whole group.  Group columns must
    not be NULL (wrap them in a struct if they can be)."""
    groups = list(group_cols)
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    keys = [*[F.col(g).asc() for g in groups], order]
    # Without an explicit count AQE sizes the blocks; it merges neighbours
    # only, so block ids stay in key order.
    ranged = (df.repartitionByRange(num_blocks, *keys) if num_blocks
              else df.repartitionByRange(*keys)).withColumn("_blk", F.spark_partition_id())
    path = scratch_path(df.sparkSession, "blocks")
    ranged.write.parquet(path)
    blocked = df.sparkSession.read.schema(ranged.schema).parquet(path)
    sums = blocked.groupBy(*groups, "_blk").agg(*[F.sum(w).alias(f"{w}_sum") for w in weight_cols])
    before = Window.partitionBy(*groups).orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    whole = Window.partitionBy(*groups)
    offsets = sums.select("*", *[F.coalesce(F.sum(f"{w}_sum").over(before), F.lit(0)).alias(f"{w}_off") for w in weight_cols],
                          *[F.sum(f"{w}_sum").over(whole).alias(f"{w}_all") for w in weight_cols])
    return blocked, offsets


def within_blocks(blocked: DataFrame, offsets: DataFrame, group_cols: Sequence[str], order_col: str,
                  weight_cols: Sequence[str], ascending: bool = True) -> DataFrame:
    """``blocked`` with ``<w>_before``: the sum of w over the rows of the group
    that come earlier, and ``<w>_all``."""
    groups = list(group_cols)
    order = F.col(order_col).asc() if ascending else F.col(order_col).desc()
    earlier = Window.partitionBy(*groups, "_blk").orderBy(order).rowsBetween(Window.unboundedPreceding, -1)
    return blocked.join(offsets, [*groups, "_blk"]).select(
        *blocked.columns,
        *[(F.col(f"{w}_off") + F.coalesce(F.sum(w).over(earlier), F.lit(0))).alias(f"{w}_before") for w in weight_cols],
        *[f"{w}_all" for w in weight_cols])


def running_totals(df: DataFrame, group_cols: Sequence[str], order_col: str, weight_cols: Sequence[str],
                   ascending: bool = True, num_blocks: int | None = None) -> DataFrame:
    """For rows unique per (group_cols, order_col), add ``<w>_before`` and
    ``<w>_all`` (see :func:`within_blocks`)."""
    blocked, offsets = value_blocks(df, group_cols, order_col, weight_cols, ascending, num_blocks)
    return within_blocks(blocked, offsets, group_cols, order_col, weight_cols, ascending)
