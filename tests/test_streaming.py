import datetime as dt

import pytest
from pyspark.sql import functions as F

from pitstop import registry as R
from pitstop.operators import drift
from pitstop.operators import score as sc
from pitstop.operators import train as T
from pitstop.operators.split import stratified_split
from pitstop.operators.transform import training_rows
from pitstop.plans import stream_jobs
from pitstop.session import scratch_path
from pitstop.streaming import drift as sdrift
from pitstop.streaming import scoring as sscore

SF = "/root/testdata/sf0.001"


def test_stream_scoring_equals_batch_and_restart_is_exactly_once(spark):
    rows = training_rows(R.features_at(spark, SF))
    sp = stratified_split(rows, "churned", "customer_id").checkpoint()
    model = T.fit(T.BASELINE, sp.where(~F.col("is_test")).drop("is_test")).model
    scorer = sscore.model_scorer(model, "m")
    reqs = R.requests(spark, SF).withColumn("request_id", F.col("customer_id"))
    src = scratch_path(spark, "req-src")
    reqs.write.parquet(src)
    log, rej, ck = (scratch_path(spark, n) for n in ("log", "rej", "ck"))

    def run():
        sscore.start_scoring_stream(sscore.request_stream(spark, src, reqs.schema), scorer, log, rej, ck,
                                    keep=("customer_id",)).awaitTermination()
    run()
    run()                   # restarts from the checkpoint: nothing new
    got = sscore.read_sink(spark, log)
    acc, rejected = sc.split_requests(reqs)
    batch = sc.log_rows(sc.score(acc, model, "m"), ("customer_id",)).drop("logged_at")
    assert got.count() == batch.count()
    assert got.drop("logged_at").exceptAll(batch).count() == 0
    assert sscore.read_sink(spark, rej).count() == rejected.count()
    # a new file is picked up on restart, once
    reqs.limit(3).withColumn("request_id", F.col("request_id") + 10**9).write.mode("append").parquet(src)
    run()
    assert sscore.read_sink(spark, log).count() + sscore.read_sink(spark, rej).count() == reqs.count() + 3


def test_a_stop_between_the_two_sinks_loses_and_repeats_nothing(spark, monkeypatch):
    reqs = R.dirty_requests(spark, SF).withColumn("request_id", F.col("customer_id"))
    src = scratch_path(spark, "req-src")
    reqs.repartition(3).write.parquet(src)
    log, rej, ck = (scratch_path(spark, n) for n in ("log", "rej", "ck"))
    scorer, write, written = sscore.column_scorer(R.fixed_formula(), "formula"), sscore.write_sink, []

    def once_broken(rows, path, batch_id):
        if path == rej and batch_id == 1 and (log, 1) in written and (rej, 1) not in written:
            written.append((rej, 1))
            raise RuntimeError("stopped between the two writes")
        written.append((path, batch_id))
        write(rows, path, batch_id)

    def run():
        stream = sscore.request_stream(spark, src, reqs.schema, max_files_per_trigger=1)
        sscore.start_scoring_stream(stream, scorer, log, rej, ck, keep=("request_id",)).awaitTermination()

    monkeypatch.setattr(sscore, "write_sink", once_broken)
    with pytest.raises(Exception, match="between the two writes"):
        run()
    assert sscore.read_sink(spark, log).count() > spark.read.parquet(f"{log}/batch_id=0").count()   # the log of batch 1 is there
    run()
    assert written.count((log, 1)) == 2 and written.count((log, 0)) == 1
    accepted, rejected = sc.split_requests(reqs)
    ids = lambda df: sorted(r[0] for r in df.select("request_id").collect())
    assert ids(sscore.read_sink(spark, log)) == ids(accepted)
    got = sscore.read_sink(spark, rej).select(*rejected.columns)
    assert got.exceptAll(rejected).count() == rejected.exceptAll(got).count() == 0 and rejected.count() > 10


def test_windowed_drift_stream_equals_batch_and_drops_late_rows(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    prof = drift.expected_profile(ev, "event_type", "value")
    # batch twin over the same windows
    batch = sdrift.windowed_psi_stream(ev, prof, "event_type", "value", "ts")
    src = scratch_path(spark, "ev-src")
    ev.write.parquet(src)
    sink, ck = scratch_path(spark, "sink"), scratch_path(spark, "ck")
    out = sdrift.windowed_psi_stream(spark.readStream.schema(ev.schema).parquet(src), prof,
                                     "event_type", "value", "ts")
    sdrift.start_drift_stream(out, sink, ck).awaitTermination()
    streamed = spark.read.parquet(sink)
    max_ts = ev.agg(F.max("ts")).first()[0]
    closed = batch.where(F.col("window_end").cast("timestamp_ntz") <= F.lit(max_ts - dt.timedelta(hours=1)))
    assert streamed.count() == closed.count() > 0
    assert streamed.exceptAll(closed).count() == 0
    # a row far behind the watermark is dropped; a closing row flushes the last day
    late = ev.limit(1).withColumn("ts", F.lit(dt.datetime(2024, 1, 2, 12)).cast("timestamp_ntz"))
    closing = ev.limit(1).withColumn("ts", F.lit(dt.datetime(2024, 2, 15)).cast("timestamp_ntz"))
    late.write.mode("append").parquet(src)
    closing.write.mode("append").parquet(src)
    out = sdrift.windowed_psi_stream(spark.readStream.schema(ev.schema).parquet(src), prof,
                                     "event_type", "value", "ts")
    sdrift.start_drift_stream(out, sink, ck).awaitTermination()
    again = spark.read.parquet(sink)
    jan2 = again.where(F.col("window_start").cast("timestamp_ntz") == F.lit(dt.datetime(2024, 1, 2)))
    assert jan2.exceptAll(closed.where(
        F.col("window_start").cast("timestamp_ntz") == F.lit(dt.datetime(2024, 1, 2)))).count() == 0
    assert again.count() >= streamed.count() + 1


def test_run_windowed_drift_job(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    out = stream_jobs.run_windowed_drift(spark, ev, "event_type", "value", "ts")
    assert out.count() > 0 and set(out.columns) >= {"window_start", "event_type", "psi", "verdict"}


def test_sliding_windows_cover_each_row_seven_times(spark):
    ev = spark.read.parquet(f"{SF}/events.parquet")
    prof = drift.expected_profile(ev, "event_type", "value")
    out = sdrift.windowed_psi_stream(ev, prof, "event_type", "value", "ts",
                                     window="7 days", slide="1 day")
    n_rows = ev.where(F.col("value").isNotNull()).count()
    assert out.agg(F.sum("n_actual")).first()[0] == 7 * n_rows
    assert out.where(F.col("psi").isNull()).count() == 0


def test_panes_divide_window_and_slide():
    assert sdrift.pane_of("7 days", "1 day") == "86400000 milliseconds"
    assert sdrift.pane_of("1 hour 30 minutes", "1 hour") == "1800000 milliseconds"
    for window, slide in (("1 day", "2 days"), ("1 month", "1 day"), ("1 day", "0 days")):
        with pytest.raises(ValueError):
            sdrift.pane_of(window, slide)


def plain_sliding(rows, edges_of, hours, step):
    """Tallies of every window that a row lies in, by hand."""
    epoch, out = dt.datetime(1970, 1, 1), {}
    for group, at, value in rows:
        if value is None:
            continue
        first = (at - epoch) // dt.timedelta(hours=step)
        for k in range(first, first - hours // step - 1, -1):
            start = epoch + k * dt.timedelta(hours=step)
            if start <= at < start + dt.timedelta(hours=hours):
                n = out.setdefault((start, group), [0, 0])
                n[0] += 1
                edges = edges_of.get(group)
                n[1] += edges is None or not edges[0] <= value <= edges[-1]
    return out


def test_sliding_stream_equals_batch_and_plain_counts(spark):
    """Overlapping windows whose slide does not divide them, unseen and NULL groups, a late row."""
    start = dt.datetime(2024, 3, 1)
    rows = [(("a", "b", None, "new")[k % 4], start + dt.timedelta(minutes=37 * k), None if k % 29 == 0 else float(k % 17)) for k in range(400)]
    schema = "grp string, ts timestamp_ntz, value double"
    live = spark.createDataFrame(rows, schema)
    old = spark.createDataFrame([(g, None, float(v)) for g in ("a", "b", None) for v in range(2, 15)], schema)
    prof = drift.expected_profile(old, "grp", "value")
    spec = dict(window="10 hours", slide="4 hours")
    batch = sdrift.windowed_psi_stream(live, prof, "grp", "value", "ts", **spec)
    got = {(r.window_start, r.grp): [r.n_actual, r.n_out_of_range] for r in
           batch.withColumn("window_start", F.col("window_start").cast("timestamp_ntz")).collect()}
    edges = {r.grp: r.edges for r in prof.collect()}
    assert got == plain_sliding(rows, edges, 10, 4)
    assert {r.grp for r in batch.where("verdict = 'NO_DATA'").collect()} == {"new"}
    # the stream, with rows in many files and one far behind the watermark
    src = scratch_path(spark, "slide-src")
    live.orderBy("ts").coalesce(1).write.option("maxRecordsPerFile", 60).parquet(src)
    late = spark.createDataFrame([("a", start, 1.0)], schema)
    closing = spark.createDataFrame([(None, start + dt.timedelta(days=40), None)], schema)
    sink, ck = scratch_path(spark, "slide-sink"), scratch_path(spark, "slide-ck")
    for extra in (None, late, closing):
        if extra is not None:
            extra.write.mode("append").parquet(src)
        out = sdrift.windowed_psi_stream(spark.readStream.schema(schema).parquet(src), prof, "grp", "value", "ts", **spec)
        sdrift.start_drift_stream(out, sink, ck).awaitTermination()
    streamed = spark.read.parquet(sink)
    assert streamed.count() == batch.count()
    assert streamed.exceptAll(batch).count() == 0
