"""Two-pass external shuffle into shards, with DataFrame functions only.

Pass 1 counts the rows by a seeded hash (a key and a count a row, no texts) and
so fixes memory-sized buckets and where each begins.  Pass 2 scatters the whole
rows into the buckets, the one time they travel, shuffles each with
Fisher-Yates (Spark's ``shuffle`` of an array) and writes it; buckets lie end to
end and the shards are equal cuts of that order."""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pitstop.llm.scratch import fresh_path, numbered_copies, running_sums, stage

BUCKET_BYTES = 16 << 20
ROW_BYTES = 96


def digests(doc_id: Column, text: Column) -> list[Column]:
    return [doc_id.alias("doc_id"), (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
            F.coalesce(F.crc32(F.encode(text, "UTF-8")), F.lit(0)).cast("long").alias("text_crc32")]


def copies(groups: DataFrame) -> DataFrame:
    """A row with its own ``_hash`` for each of the ``_same`` rows of a group."""
    return numbered_copies(groups, "_same", "_copy").withColumn("_hash", F.xxhash64("_key", "_copy")).drop("_copy")


def shard(docs: DataFrame, shards: int = 8, seed: int = 29, bucket_bytes: int = BUCKET_BYTES,
          columns: Sequence[str] = ("doc_id", "text"), carry: Sequence[str] = ()) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row,
    and the columns named by ``carry`` in a struct ``row``.

    The law is `rows`: shard counts differ by at most one, and the slots of a
    shard run from 0 without gaps.  A bucket takes the rows whose hash, over
    all that is kept of them, falls to it.  Rows with equal ids or texts
    scatter; only rows alike in all columns meet, and a group of those that
    would fill half a bucket is pre-aggregated to one row with a count,
    whose copies then scatter too.  Identical rows are told apart by nothing
    but their slot.  A null text has size 1 and CRC 0; a null doc_id is an id;
    an empty table gives an empty result.  Reruns agree: bucket arrays are
    sorted before they are shuffled and a bucket is the task of its number."""
    doc_id, text = columns
    narrow = docs.select(*digests(F.col(doc_id), F.col(text)),
                         *([F.struct(*[F.col(c) for c in carry]).alias("row")] if carry else []))
    kept = narrow.columns
    keyed = narrow.withColumn("_key", F.xxhash64(F.lit(seed), *kept))
    weight = F.lit(ROW_BYTES) + (F.col("size") if carry else F.lit(0))
    groups = stage(keyed.groupBy("_key").agg(F.count("*").alias("_same"), F.sum(weight).alias("_bytes")), "shard-groups")
    large = (F.col("_same") > 1) & (F.col("_bytes") > bucket_bytes // 2)      # fewer than 2 a bucket
    rows, volume, hot = groups.agg(F.sum("_same"), F.sum("_bytes"), F.count_if(large)).first()
    buckets = max(1, math.ceil((volume or 0) / bucket_bytes))
    bucket = F.pmod(F.col("_hash"), F.lit(buckets)).cast("int").alias("_bucket")
    numbers = groups.withColumn("_hash", F.col("_key")).select(bucket, "_same")
    scattered = keyed.withColumn("_hash", F.col("_key"))
    if hot:
        few = groups.filter(large).select("_key")
        alike = keyed.join(few, "_key", "left_semi").groupBy("_key", *kept).agg(F.count("*").alias("_same"))
        scattered = scattered.join(few, "_key", "left_anti").unionByName(copies(alike))
        numbers = (groups.filter(~large).withColumn("_hash", F.col("_key")).select(bucket, "_same")
                   .union(copies(groups.filter(large).select("_key", "_same")).select(bucket, F.lit(1))))
    starts = running_sums(numbers.groupBy("_bucket").agg(F.sum("_same").alias("_n")),
                          ["_bucket"], {"_start": "_n"}, "shard-starts").select("_bucket", "_start")
    arrays = (scattered.select(bucket, "_hash", *kept).repartitionById(buckets, "_bucket")
              .groupBy("_bucket").agg(F.sort_array(F.collect_list(F.struct("_hash", *kept))).alias("_rows")))
    mixed = arrays.select("_bucket", F.shuffle("_rows", seed).alias("_rows")).join(starts, "_bucket")
    chosen = (mixed.select("_start", F.posexplode("_rows").alias("_at", "_r"))
              .select("_r.*", (F.col("_start") + F.col("_at")).alias("_pos"),
                      F.expr(f"(_start + _at) * {shards}L div {max(rows or 0, 1)}L").alias("_s")))
    return chosen.select("doc_id", "size", "text_crc32", F.lit("rows").alias("law"), F.col("_s").cast("int").alias("shard"),
                         (F.col("_pos") - F.expr(f"(_s * {rows or 0}L + {shards - 1}L) div {shards}L")).alias("slot"),
                         F.lit(None).cast("int").alias("grown_shard"), *(["row"] if carry else []))


def write_shards(docs: DataFrame, path: str, shards: int = 8, **options) -> None:
    """The rows of ``docs`` as Parquet folders shard=0 ... under ``path``;
    column ``slot`` is kept beside the struct ``row``.  A task writes its
    bucket, in slot order, to the one or few shards that it lies in.  Nulls,
    ties, repeated rows and empty texts are rows like others (see
    :func:`shard`); an empty table writes no shard."""
    placed = shard(docs, shards, carry=docs.columns, **options).select("row", "shard", "slot")
    placed.sortWithinPartitions("shard", "slot").write.partitionBy("shard").parquet(path)


def write_and_read(docs: DataFrame, shards: int = 8, columns: Sequence[str] = ("doc_id", "text"), **options) -> DataFrame:
    """The columns of :func:`shard` without ``row``, taken from shards that
    hold the whole rows, written to the shared folder and read back; nulls,
    ties and empty tables as there."""
    doc_id, text = (F.col(f"row.`{c}`") for c in columns)
    path = fresh_path(docs.sparkSession, "shards")
    write_shards(docs, path, shards, columns=columns, **options)
    back = docs.sparkSession.read.schema(
        docs.select(F.struct("*").alias("row")).schema.add("slot", "long").add("shard", "integer")).parquet(path)
    return back.select(*digests(doc_id, text), F.lit("rows").alias("law"), "shard", "slot",
                       F.lit(None).cast("int").alias("grown_shard"))
