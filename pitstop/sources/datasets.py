"""Versioned feature datasets and the append-only prediction log.

A dataset is Parquet partitioned by ``cutoff_date``; publishing a cutoff
overwrites that partition only (dynamic partition overwrite), so re-runs are
idempotent and other cutoffs stay untouched.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitstop.functions.dates import as_date  # noqa: F401 (re-export)


def with_cutoff(df: DataFrame, cutoff) -> DataFrame:
    """``df`` with its cutoff; rows that carry another cutoff are refused."""
    if "cutoff_date" in df.columns:
        other = df.where(~F.col("cutoff_date").eqNullSafe(F.lit(as_date(cutoff)))).limit(1).count()
        if other:
            raise ValueError(f"rows of another cutoff than {as_date(cutoff)}")
        return df
    return df.withColumn("cutoff_date", F.lit(as_date(cutoff)))


def write_dataset(df: DataFrame, path: str, cutoff=None) -> str:
    out = with_cutoff(df, cutoff) if cutoff is not None else df
    if "cutoff_date" not in out.columns:
        raise ValueError("a cutoff_date column or a cutoff argument is required")
    (out.write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic")
     .partitionBy("cutoff_date")
     .parquet(path))
    return path


def read_dataset(spark: SparkSession, path: str, cutoff=None,
                 schema: T.StructType | None = None) -> DataFrame:
    """Read a published dataset; a cutoff prunes to its partition."""
    r = spark.read
    if schema is not None:
        r = r.schema(schema)
    df = r.parquet(path)
    if cutoff is not None:
        df = df.where(F.col("cutoff_date") == F.lit(as_date(cutoff)))
    return df


def version_path(path: str, cutoff) -> str:
    return f"{path.rstrip('/')}/cutoff_date={as_date(cutoff).isoformat()}"


def write_version(df: DataFrame, path: str, cutoff) -> DataFrame:
    """One cutoff's partition, also if it has no rows (dynamic overwrite would
    leave what was there); returns it read back, without ``cutoff_date``."""
    df.write.mode("overwrite").parquet(version_path(path, cutoff))
    return read_version(df.sparkSession, path, cutoff)


def read_version(spark: SparkSession, path: str, cutoff) -> DataFrame:
    return spark.read.parquet(version_path(path, cutoff))


def append_log(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """Append rows to the prediction log (batch form of the streaming sink)."""
    w = df.write.mode("append")
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)
    return path


def cutoff_partitions(spark: SparkSession, path: str) -> list[dt.date]:
    """Published cutoffs (distinct partition values; a tiny result)."""
    return [r[0] for r in read_dataset(spark, path).select("cutoff_date").distinct()
            .orderBy("cutoff_date").collect()]
