"""Every registered query against its DuckDB twin at sf0.01 (the driver's
correctness gate), and the rows-only ones at sf0.001."""

import pytest
from oracle_check import compare, type_mismatches

import __spark_entry__ as E

SF001 = "/root/testdata/sf0.01"
SF0001 = "/root/testdata/sf0.001"
Q, O = E.queries(), E.oracle_sql()


def test_every_oracle_key_is_a_query():
    assert set(O) <= set(Q)


@pytest.mark.parametrize("name", sorted(O))
def test_query_matches_duckdb(spark, name):
    df = Q[name](spark, SF001)
    r = compare(df, O[name], SF001)
    assert r["ok"], r
    assert type_mismatches(df, O[name], SF001) == {}


@pytest.mark.parametrize("name", sorted(set(Q) - set(O) - {"model_metrics"}))
def test_rows_only_queries_run(spark, name):
    assert Q[name](spark, SF0001).count() > 0


def test_entry(spark):
    df = E.entry(spark)
    assert df.count() > 0 and "churned" in df.columns
