"""Whether two frames hold the same rows, as often, in any order.

Both are reduced to a fingerprint: rows are dealt to buckets by a hash, and a
bucket keeps its count and two sums of row hashes, which no order changes.
Only the rows of buckets that differ are compared themselves, so two equal
tables cost one pass each and no shuffle of rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BUCKETS = 4096


def _plain(df: DataFrame) -> list[Column]:
    """The columns by name; -0.0 as 0.0, which are one value."""
    def column(f: T.StructField) -> Column:
        c = F.col(f"`{f.name}`")
        return F.when(c == 0, F.lit(0.0).cast(f.dataType)).otherwise(c).alias(f.name) if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else c
    return [column(f) for f in sorted(df.schema, key=lambda f: f.name)]


def _dealt(df: DataFrame, buckets: int) -> DataFrame:
    plain = df.select(*_plain(df))
    cols = [F.col(f"`{c}`") for c in plain.columns]
    # What is hashed tells a NULL from what is not there: xxhash64 alone skips it.
    known = F.concat(*[F.col(f"`{c}`").isNull().cast("string") for c in plain.columns])
    return (plain.withColumn("_h", F.xxhash64(*cols, known)).withColumn("_h2", F.xxhash64(F.lit("second"), known, *reversed(cols)))
            .withColumn("_bucket", F.pmod(F.xxhash64("_h", F.lit(7)), F.lit(buckets))))


def fingerprint(df: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket, n, s1, s2): at most ``buckets`` rows, partially aggregated."""
    return _dealt(df, buckets).groupBy("_bucket").agg(
        F.count(F.lit(1)).alias("n"), *[F.sum(F.col(h).cast("decimal(20,0)")).alias(s) for h, s in (("_h", "s1"), ("_h2", "s2"))])


def differing_buckets(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """(_bucket) of the buckets whose fingerprints are not the same."""
    _same_columns(a, b)
    both = fingerprint(a, buckets).join(fingerprint(b, buckets).selectExpr("_bucket", "n AS m", "s1 AS t1", "s2 AS t2"), "_bucket", "full")
    return both.where("NOT (n <=> m AND s1 <=> t1 AND s2 <=> t2)").select("_bucket")


def _same_columns(a: DataFrame, b: DataFrame) -> None:
    kinds = [sorted((f.name, f.dataType.simpleString()) for f in df.schema) for df in (a, b)]
    if kinds[0] != kinds[1]:
        raise ValueError(f"the frames have different columns: {set(kinds[0]) ^ set(kinds[1])}")


def equivalent(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> bool:
    """Two passes over narrow sums; no row is shuffled."""
    return differing_buckets(a, b, buckets).isEmpty()


def difference(a: DataFrame, b: DataFrame, buckets: int = BUCKETS) -> DataFrame:
    """The rows that are not as often in one frame as in the other: the columns
    of ``a``, n_left and n_right.  NULLs are equal to each other, and NaNs.
    Give it tables: each side is read for its fingerprint and, where buckets
    differ, for their rows."""
    apart = F.broadcast(differing_buckets(a, b, buckets))       # at most `buckets` rows
    names = a.columns

    def side(df: DataFrame, left: int) -> DataFrame:
        rows = _dealt(df, buckets).join(apart, "_bucket", "left_semi")
        return rows.select(*[F.col(f"`{c}`") for c in names], F.lit(left).cast("long").alias("n_left"),
                           F.lit(1 - left).cast("long").alias("n_right"))
    return (side(a, 1).unionByName(side(b, 0)).groupBy(*[F.col(f"`{c}`") for c in names])
            .agg(F.sum("n_left").alias("n_left"), F.sum("n_right").alias("n_right")).where("n_left <> n_right"))
