"""Runnable streaming jobs over files: stage a source folder, run the
stream to completion (available-now trigger), read the committed sink.

All folders are fresh paths below the shared checkpoint root."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from pitstop.operators import drift
from pitstop.session import scratch_path
from pitstop.streaming import drift as sdrift
from pitstop.streaming import scoring as sscore


def stage_files(df: DataFrame, name: str) -> str:
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return path


def run_windowed_drift(spark: SparkSession, events: DataFrame, group_col: str, value_col: str,
                       ts_col: str, window: str = "1 day", watermark: str = "1 hour",
                       edge_digits: int | None = None, expected: DataFrame | None = None,
                       slide: str | None = None) -> DataFrame:
    """Expected profile in batch (default: the events themselves), then the
    events as a file stream through the watermarked windowed PSI.  A closing
    row without a value, later than every window and its delay, follows the
    events, so that the last windows are emitted too."""
    profile = drift.expected_profile(expected if expected is not None else events, group_col,
                                     value_col, edge_digits=edge_digits)
    src = stage_files(events, "drift-source")
    kind = events.schema[ts_col].dataType.simpleString()
    closing = (events.agg(F.max(ts_col).alias("_last")).where("_last IS NOT NULL")
               .select(*[(F.expr(f"_last + 2 * INTERVAL {window} + 2 * INTERVAL {watermark}") if c == ts_col else F.lit(None))
                         .cast(kind if c == ts_col else events.schema[c].dataType).alias(c) for c in events.columns]))
    closing.write.mode("append").parquet(src)
    stream = spark.readStream.schema(events.schema).parquet(src)
    out = sdrift.windowed_psi_stream(stream, profile, group_col, value_col, ts_col, window=window,
                                     slide=slide, watermark=watermark)
    sink = scratch_path(spark, "drift-sink")
    q = sdrift.start_drift_stream(out, sink, scratch_path(spark, "drift-checkpoint"))
    q.awaitTermination()
    return spark.read.parquet(sink)


def run_streaming_scoring(spark: SparkSession, requests: DataFrame, scorer: sscore.Scorer,
                          keep: tuple[str, ...] = ("customer_id", "request_id")) -> tuple[DataFrame, DataFrame]:
    """Stage request rows as files, score them as a stream, return (log, rejects)."""
    src = stage_files(requests, "score-source")
    log_p, rej_p = scratch_path(spark, "score-log"), scratch_path(spark, "score-rejects")
    sscore.start_scoring_stream(sscore.request_stream(spark, src, requests.schema), scorer, log_p, rej_p,
                                scratch_path(spark, "score-checkpoint"), keep=keep).awaitTermination()
    return sscore.read_sink(spark, log_p), sscore.read_sink(spark, rej_p)
