import datetime as dt
import os

import pytest

from pitstop.plans.drift_job import log_drift, log_windowed_drift
from pitstop.session import scratch_path
from pitstop.sources import datasets
from pitstop.sources import schemas as S
from pitstop.sources import tables as tb
from pitstop.sources.readers import read_csv_table

CSV = """order_id,customer_id,order_date,status,order_total
1,10,2026-01-01 00:00:00,completed,10.50
2,11,,pending,
3,,2026-02-03 10:11:12,cancelled,0.00
"""


def write(spark, text):
    d = scratch_path(spark, "csv")
    os.makedirs(d)
    with open(f"{d}/part.csv", "w") as f:
        f.write(text)
    return d


def test_csv_typed_load_with_empty_nulls(spark):
    df = read_csv_table(spark, write(spark, CSV), S.ORDERS)
    rows = {r.order_id: r for r in df.collect()}
    assert rows[1].order_date == dt.datetime(2026, 1, 1) and float(rows[1].order_total) == 10.5
    assert rows[2].order_date is None and rows[2].order_total is None
    assert rows[3].customer_id is None
    assert dict(df.dtypes)["order_date"] == "timestamp_ntz"


def test_csv_malformed_row_fails(spark):
    bad = CSV + "x,1,2026-01-01 00:00:00,completed,1.00\n"
    with pytest.raises(Exception):
        read_csv_table(spark, write(spark, bad), S.ORDERS).collect()


def test_driver_tables_read_with_declared_schemas(spark):
    sf = "/root/testdata/sf0.001"
    for name, schema in tb.DRIVER_SCHEMAS.items():
        inferred = spark.read.parquet(f"{sf}/{name}.parquet").schema
        declared = tb.raw(spark, sf, name).schema
        assert [(f.name, f.dataType) for f in declared] == [(f.name, f.dataType) for f in inferred]


def test_a_cutoff_that_the_rows_contradict_is_refused(spark):
    df = spark.createDataFrame([(1, dt.date(1996, 1, 1)), (2, dt.date(1997, 1, 1))], "customer_id long, cutoff_date date")
    path = scratch_path(spark, "versions")
    with pytest.raises(ValueError):
        datasets.write_dataset(df, path, dt.date(2020, 1, 1))
    datasets.write_dataset(df, path)
    datasets.write_dataset(df.limit(1).where("customer_id = 1"), path, dt.date(1996, 1, 1))
    assert datasets.cutoff_partitions(spark, path) == [dt.date(1996, 1, 1), dt.date(1997, 1, 1)]


def test_the_drift_job_reads_a_csv_log(spark):
    names = S.SCORING_REQUEST.fieldNames()
    rows = spark.createDataFrame([(i, float(i), i % 5, i, 2 * i) for i in range(200)],
                                 "order_count long, total_spend double, distinct_products long, recency_days long, tenure_days long")
    path = scratch_path(spark, "features")
    datasets.write_dataset(rows, path, dt.date(2020, 1, 1))
    log = scratch_path(spark, "log") + ".csv"
    datasets.append_log(rows.selectExpr(*names, "0.5D AS churn_probability", "TIMESTAMP '2020-02-03 04:05:06' AS logged_at"), log, "csv")
    got = log_drift(spark, path, dt.date(2020, 1, 1), log).collect()
    assert sorted(r.feature for r in got) == sorted(names) and all(r.psi == 0 and r.n_actual == 200 for r in got)
    windows = log_windowed_drift(spark, path, dt.date(2020, 1, 1), log).collect()
    assert len(windows) == 5 and all(r.verdict == "OK" for r in windows)
