"""Streaming windowed drift: PSI per (event-time window, group) against a
fixed expected profile.

The profile (a table, see :func:`pitstop.operators.drift.expected_profile`) is
joined to the stream as a static side; tumbling windows are one watermarked
aggregation with a tally per edge.  Its state is (#open windows x #groups)
rows, bounded by the watermark.  Rows later than the watermark are dropped.

Sliding windows share panes: a row is tallied once, in the pane it lies in (the
largest step that divides window and slide), and a second watermarked
aggregation adds the closed panes up, so that window / slide copies are made of
pane rows instead of input rows.
"""

from __future__ import annotations

import math
from datetime import timedelta

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from pitstop.functions.exprs import psi_verdict
from pitstop.operators.drift import DEFAULT_BUCKETS, _clean, _psi, against_profile, live_tallies, tally_names


_UNITS = ("weeks", "days", "hours", "minutes", "seconds", "milliseconds")


def interval_ms(text: str) -> int:
    """Milliseconds of an interval such as "7 days" or "1 hour 30 minutes"."""
    words = text.lower().replace("interval", "").split()
    total = timedelta()
    for number, unit in zip(words[::2], words[1::2], strict=True):
        name = unit if unit.endswith("s") else unit + "s"
        if name not in _UNITS:
            raise ValueError(f"no fixed length: {text}")
        total += timedelta(**{name: float(number)})
    return round(total / timedelta(milliseconds=1))


def pane_of(window: str, slide: str) -> str:
    """The pane that windows of this length and slide are made of."""
    length, step = interval_ms(window), interval_ms(slide)
    if not 0 < step <= length:
        raise ValueError(f"a slide is longer than nothing and at most the window: {slide}, {window}")
    return f"{math.gcd(length, step)} milliseconds"


def windowed_psi_stream(events: DataFrame, profile: DataFrame, group_col: str, value_col: str,
                        ts_col: str, window: str = "1 day", slide: str | None = None,
                        watermark: str = "1 hour", buckets: int = DEFAULT_BUCKETS) -> DataFrame:
    """Streaming (or batch) frame of PSI per closed window and group; with
    ``slide`` the windows overlap.  Groups that the profile does not have get
    a row with ``NO_DATA``; a group has a row for the windows it has values
    in.  Rows without a value are not counted but move the watermark, so that
    one can close the last windows (a filter would be pushed below the
    watermark)."""
    rows = (events.select(F.col(ts_col).cast("timestamp").alias("_ts"),   # watermarks need TIMESTAMP (not _NTZ)
                          F.struct(F.col(group_col).alias("g")).alias("_g"), _clean(F.col(value_col)).alias("_v"))
            .withWatermark("_ts", watermark))
    counted = live_tallies(rows, profile, group_col, [F.window("_ts", pane_of(window, slide) if slide else window).alias("w")], buckets)
    if slide:
        sliding = F.window(F.window_time("w"), window, slide).alias("w")
        counted = counted.groupBy(sliding, "_g").agg(*[F.sum(c).alias(c) for c in ("n_actual", *tally_names(buckets))])
    return (against_profile(counted.where("n_actual > 0"), profile, group_col, buckets)
            .select(F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"),
                    group_col, "n_actual", "n_out_of_range", _psi().alias("psi"))
            .withColumn("verdict", psi_verdict(F.col("psi"))))


def start_drift_stream(df: DataFrame, sink_path: str, checkpoint_dir: str,
                       available_now: bool = True) -> StreamingQuery:
    """Start the stream into a Parquet file sink (exactly-once).  The state
    has as many partitions as ``spark.sql.shuffle.partitions`` says when the
    checkpoint is first created."""
    w = (df.writeStream.format("parquet").outputMode("append")
         .option("checkpointLocation", checkpoint_dir))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start(sink_path)
