"""Reproducible stratified train/test split.

Class sizes follow the stratified shuffle split rule: ``n_test = ceil(f * N)``,
per-class train counts by the largest-remainder rule on ``n_train`` (ties to
the smaller label), test = the rest of each class.  Which rows go to test is
decided by a seeded hash: rows of class k are ordered by
``md5("<seed>:<id>")`` (then id) and the first ``test_k`` are test rows.
The split depends only on (seed, id) values: stable under repartitioning
and re-execution.

Scale: the hash's first 4 hex digits define 65,536 buckets.  Bucket counts
per class (a small table) tell in which bucket a class is cut, and only that
bucket's rows (about N_k / 65,536) are ranked, to find the last test row.
``is_test`` is then a comparison with that row: besides counting and finding
the cuts, the input is read once, without a window or union over it.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from pitstop.session import scratch_path

HASH_BUCKETS = 16 ** 4


def split_hash(id_col: str, seed: int) -> F.Column:
    return F.md5(F.concat(F.lit(f"{seed}:"), F.col(id_col).cast("string")))


def class_allocation(class_counts: dict, test_fraction: float) -> dict:
    """Per class number of test rows (stratified shuffle split sizes)."""
    labels = sorted(class_counts)
    n = sum(class_counts[k] for k in labels)
    n_test = math.ceil(test_fraction * n)
    n_train = n - n_test
    cont = {k: class_counts[k] / n * n_train for k in labels}
    floored = {k: math.floor(cont[k]) for k in labels}
    need = n_train - sum(floored.values())
    for k in sorted(labels, key=lambda k: (-(cont[k] - floored[k]), k))[:max(need, 0)]:
        floored[k] += 1
    return {k: class_counts[k] - floored[k] for k in labels}


def stratified_split(df: DataFrame, label_col: str, id_col: str, test_fraction: float = 0.2,
                     seed: int = 42) -> DataFrame:
    """Add ``is_test`` (boolean) to every row of ``df``.  Ids are unique
    within a class."""
    spark = df.sparkSession
    h = split_hash(id_col, seed)
    keyed = df.select(F.col(label_col).alias("_y"), F.col(id_col).alias("_id"), h.alias("_h")).withColumn(
        "_b", F.conv(F.substring("_h", 1, 4), 16, 10).cast("int"))
    path = scratch_path(spark, "split-counts")
    keyed.groupBy("_y", "_b").agg(F.count(F.lit(1)).alias("_n")).write.parquet(path)
    counts = spark.read.parquet(path)
    per_class = {r[0]: int(r[1]) for r in counts.groupBy("_y").agg(F.sum("_n")).collect()}   # a row a class
    if None in per_class:
        raise ValueError("NULL labels cannot be stratified; drop them first")
    kind = df.schema[label_col].dataType.simpleString()
    test = spark.createDataFrame(list(class_allocation(per_class, test_fraction).items()) if per_class else [],
                                 f"_y {kind}, _tk long")
    before = Window.partitionBy("_y").orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    cuts = (counts.withColumn("_before", F.coalesce(F.sum("_n").over(before), F.lit(0))).join(test, "_y")
            .where((F.col("_before") < F.col("_tk")) & (F.col("_tk") <= F.col("_before") + F.col("_n")))
            .select("_y", "_b", (F.col("_tk") - F.col("_before")).alias("_need")))
    nth = F.row_number().over(Window.partitionBy("_y").orderBy("_h", "_id"))
    path = scratch_path(spark, "split-cuts")
    (keyed.join(cuts, ["_y", "_b"]).withColumn("_nth", nth).where("_nth = _need")
     .select("_y", F.struct("_h", "_id").alias("_last")).write.parquet(path))
    lasts = spark.read.parquet(path)   # a row a class; a class without test rows has none
    return (df.join(lasts, F.col(label_col) == F.col("_y"), "left")
            .select(*df.columns, F.coalesce(F.struct(h.alias("_h"), F.col(id_col).alias("_id")) <= F.col("_last"),
                                            F.lit(False)).alias("is_test")))
