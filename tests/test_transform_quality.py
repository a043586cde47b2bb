import pytest
from pyspark.sql import functions as F

from pitstop.operators import quality as dq
from pitstop.operators.transform import training_rows, transform_features
from pitstop.plans.dataset_job import publish_features
from pitstop.sources import datasets
from pitstop.session import scratch_path

SCHEMA = ("customer_id long, order_count double, total_spend double, distinct_products double, "
          "recency_days double, tenure_days double, churned double")


def frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


NAMES = [c.split(" ")[0] for c in SCHEMA.split(", ")]


def person(key, **values):
    """A sound row of our own, but for the given fields."""
    row = {"customer_id": key, "order_count": 4.0, "total_spend": 77.25, "distinct_products": 6.0, "recency_days": 21.0,
           "tenure_days": 512.0, "churned": 0.0} | values
    return tuple(row[n] for n in NAMES)


def test_every_fill_and_the_recency_cap(spark):
    gaps = {n: None for n in NAMES[1:]}
    rows = [person(7), person(8, **gaps), person(9, recency_days=731.0), person(10, recency_days=float("nan"), total_spend=float("nan"))]
    got = {r.customer_id: r.asDict() for r in transform_features(frame(spark, rows)).collect()}
    assert len(got) == 4
    assert got[7] == {"customer_id": 7, "order_count": 4, "total_spend": 77.25, "distinct_products": 6, "recency_days": 21,
                      "tenure_days": 512, "churned": 0}
    assert got[8] == {"customer_id": 8, "order_count": 0, "total_spend": 0.0, "distinct_products": 0, "recency_days": 730,
                      "tenure_days": 0, "churned": 0}
    assert got[9]["recency_days"] == 730 and got[10]["recency_days"] == 730 and got[10]["total_spend"] == 0.0


def test_integers_beyond_doubles_stay_exact(spark):
    big = 2**53 + 1
    out = transform_features(spark.createDataFrame([(1, big)], "customer_id long, order_count long")).first()
    assert out.order_count == big


def failed_checks(df):
    return {r.check for r in dq.validate_report(df).collect() if not r.passed}


@pytest.mark.parametrize("second, check", [
    (person(11), "key_unique"), (person(12, total_spend=-0.01), "total_spend_nonneg"),
    (person(12, order_count=-1.0), "order_count_nonneg"), (person(12, churned=0.5), "churned_binary"),
    (person(12, distinct_products=None), "null_fraction")])
def test_one_bad_row_fails_its_check_alone(spark, second, check):
    df = frame(spark, [person(11), second])
    assert failed_checks(df) == {check}
    with pytest.raises(dq.ValidationError, match=check):
        dq.validate(df)


def test_a_sound_frame_passes_and_keys_can_be_lists(spark):
    sound = transform_features(frame(spark, [person(1), person(2, churned=1.0)]))
    assert dq.validate(sound).count() == 7
    twice = sound.withColumn("cutoff_date", F.lit("2020-01-01")).unionByName(sound.withColumn("cutoff_date", F.lit("2021-01-01")))
    assert failed_checks(twice) == {"key_unique"}
    assert dq.validate(twice, key=["cutoff_date", "customer_id"]).filter("passed").count() == 7


def test_validate_more_failures(spark):
    assert "non_empty" in failed_checks(frame(spark, []))
    assert failed_checks(frame(spark, [(1, 1.0, 1.0, 1.0, 1.0, 1.0, 2.0)])) == {"churned_binary"}
    assert "order_count_nonneg" in failed_checks(frame(spark, [(1, None, 1.0, 1.0, 1.0, 1.0, 0.0)]))
    missing = frame(spark, [(1, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0)]).drop("tenure_days")
    assert "required_columns" in failed_checks(missing)
    base = [(i, 1.0, 1.0, 1.0, 1.0, 1.0, 0.0) for i in range(200)]
    one_pct = [(i, 1.0, 1.0, 1.0, 1.0, None if i < 2 else 1.0, 0.0) for i in range(200)]
    half_pct = [(i, 1.0, 1.0, 1.0, 1.0, None if i < 1 else 1.0, 0.0) for i in range(200)]
    assert failed_checks(frame(spark, base)) == set()
    assert failed_checks(frame(spark, one_pct)) == {"null_fraction"}   # limit is strict
    assert failed_checks(frame(spark, half_pct)) == set()


def test_training_rows_drop_before_cap(spark):
    df = frame(spark, [(1, 1.0, 1.0, 1.0, None, 1.0, 0.0), (2, 1.0, 1.0, 1.0, 9999.0, 1.0, 1.0)])
    out = training_rows(df).collect()
    assert [(r.customer_id, r.recency_days) for r in out] == [(2, 730.0)]


def test_publish_idempotent_and_bad_data_writes_nothing(spark):
    good = frame(spark, [(1, 1.0, 10.0, 1.0, 5.0, 100.0, 0.0), (2, 2.0, 20.0, 2.0, 15.0, 200.0, 1.0)])
    path = scratch_path(spark, "dataset")
    for _ in range(2):
        res = publish_features(good, path, "2026-01-01")
        assert res.passed
    publish_features(good.where("customer_id = 1"), path, "2026-02-01")
    back = datasets.read_dataset(spark, path)
    assert back.count() == 3
    import datetime as dt
    assert datasets.cutoff_partitions(spark, path) == [dt.date(2026, 1, 1), dt.date(2026, 2, 1)]
    assert datasets.read_dataset(spark, path, "2026-01-01").count() == 2
    bad = frame(spark, [(1, 1.0, -1.0, 1.0, 5.0, 100.0, 0.0)])
    with pytest.raises(AssertionError):
        publish_features(bad, path, "2026-03-01")
    assert datasets.read_dataset(spark, path, "2026-03-01").count() == 0


def test_dedup_keeps_lowest_id(spark):
    df = spark.createDataFrame([(5, 1, 9, 2), (3, 1, 9, 7), (4, 1, 8, 1)],
                               "order_item_id long, order_id long, product_id long, quantity int")
    out = sorted(tuple(r) for r in dq.dedup_keep_lowest(df, ["order_id", "product_id"],
                                                        "order_item_id").collect())
    assert out == [(3, 1, 9, 7), (4, 1, 8, 1)]
    dups = dq.duplicate_keys(df, ["order_id", "product_id"]).collect()
    assert [(r.order_id, r.product_id, r.n_rows) for r in dups] == [(1, 9, 2)]


def test_fk_orphans_allow_null(spark):
    child = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k long")
    parent = spark.createDataFrame([(1,)], "k long")
    r = dq.fk_orphans(child, "k", parent, "k", "c->p").first()
    assert (r.n_checked, r.n_orphans) == (3, 1)


def test_null_rates(spark):
    df = spark.createDataFrame([(1, None), (2, 3.0), (None, float("nan"))], "a long, b double")
    got = {r.column_name: (r.n_null, r.null_rate) for r in dq.null_rates(df, "t").collect()}
    assert got["a"] == (1, pytest.approx(1 / 3)) and got["b"] == (2, pytest.approx(2 / 3))
