"""Shared-folder tables and distributed ordering used by the operators."""

from __future__ import annotations

import functools
import os
import re
import tempfile
import uuid
from collections.abc import Callable, Mapping, Sequence

from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


#: For Python workers that many jobs share: freed memory goes back to the system
#: and is not kept for the next one.  (glibc otherwise keeps arrays of up to 32 MB
#: in its heap once one was freed; the faults of fresh pages cost some CPU time.)
FREES_MEMORY = {"MALLOC_MMAP_THRESHOLD_": str(1 << 20), "MALLOC_TRIM_THRESHOLD_": str(1 << 20), "MALLOC_ARENA_MAX": "1",
                "ARROW_DEFAULT_MEMORY_POOL": "system"}


def with_package(query: Callable, worker_env: Mapping[str, str] | None = None) -> Callable:
    """``query(spark, ...)`` whose Python workers look for this package where
    the driver has it, if they do not find it elsewhere.  (A cluster whose
    machines do not have the folder gets the package with --py-files.)
    ``worker_env`` is for these workers too; what spark.executorEnv says holds."""
    home = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

    @functools.wraps(query)
    def run(spark: SparkSession, *args):
        env = spark.sparkContext.environment
        paths = [p for p in env.get("PYTHONPATH", "").split(os.pathsep) if p]
        if home not in paths:
            env["PYTHONPATH"] = os.pathsep.join([*paths, home])
        for name, value in (worker_env or {}).items():
            env.setdefault(name, value)
        return query(spark, *args)
    return run


def shared_root(spark: SparkSession) -> str:
    """The folder named by ``spark.checkpoint.dir``.  Only a local session
    (tests) that leaves it unset gets a private one."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        root = tempfile.mkdtemp(prefix="pitstop-llm-")
        spark.conf.set("spark.checkpoint.dir", root)
    return root.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_root(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def stage(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back: cuts the lineage,
    keeps column pruning, and survives the loss of any executor."""
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def write_file(folder: str, name: str, content: bytes) -> None:
    """From inside a task: the file is written under another name and renamed,
    so that a reader meets whole files only.  Hadoop's names of object stores
    are translated to Arrow's."""
    store, base = fs.FileSystem.from_uri(re.sub("^s3[an]://", "s3://", folder))
    store.create_dir(base, recursive=True)
    hidden = f"{base}/_{name}.{TaskContext.get().taskAttemptId()}"
    with store.open_output_stream(hidden, compression=None) as out:
        out.write(content)
    store.move(hidden, f"{base}/{name}")


def ordered_blocks(df: DataFrame, order: Sequence, name: str) -> DataFrame:
    """``df`` range-partitioned by ``order`` and staged with ``_blk``, a block
    number that rises with the order.  Staging freezes the sampled range
    bounds, so a recomputed task cannot see others."""
    return stage(df.repartitionByRange(*order).withColumn("_blk", F.spark_partition_id()), name)


def running_sums(df: DataFrame, order: Sequence, sums: dict[str, str], name: str) -> DataFrame:
    """Exclusive running sums over one global order: ``sums`` maps an output
    column to the summed column.  Blocks are summed first, then a window runs
    over the block sums (a row a partition) and one inside each block."""
    blocked = ordered_blocks(df, order, name)
    before = Window.orderBy("_blk").rowsBetween(Window.unboundedPreceding, -1)
    totals = blocked.groupBy("_blk").agg(*[F.sum(c).alias(f"_s_{o}") for o, c in sums.items()])
    offsets = totals.select("_blk", *[
        F.coalesce(F.sum(f"_s_{o}").over(before), F.lit(0)).alias(f"_o_{o}") for o in sums])
    inside = Window.partitionBy("_blk").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    out = blocked.join(F.broadcast(offsets), "_blk")   # a row a partition
    return out.select(*df.columns, *[
        (F.col(f"_o_{o}") + F.coalesce(F.sum(c).over(inside), F.lit(0))).alias(o)
        for o, c in sums.items()])


CHUNK = 4096                  # copies of one row that are made at a time


def numbered_copies(groups: DataFrame, count: str, number: str) -> DataFrame:
    """Each row of ``groups`` ``count`` times, numbered from 0 in column
    ``number`` instead; a large group's chunks are dealt to many tasks before
    they are spread out."""
    small = groups.filter(F.col(count) <= CHUNK).select(
        "*", F.explode(F.expr(f"sequence(0L, `{count}` - 1)")).alias(number))
    large = groups.filter(F.col(count) > CHUNK).select(
        "*", F.explode(F.expr(f"sequence(0L, (`{count}` - 1) div {CHUNK})")).alias("_chunk"))
    spread = large.repartition(F.xxhash64(*groups.columns, "_chunk")).select(
        "*", F.explode(F.expr(f"sequence(_chunk * {CHUNK}, least(`{count}`, (_chunk + 1) * {CHUNK}) - 1)")).alias(number)).drop("_chunk")
    return small.unionByName(spread).drop(count)
