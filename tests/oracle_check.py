"""Local stand-in for the driver's correctness gate: run a Spark query and a
DuckDB SQL string on the same Parquet tables and compare row count, column
names and an order-insensitive hash of the (rounded) values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


DIGITS = None   # None: compare floats exactly (repr); an int rounds first


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(float(v) if DIGITS is None else round(v, DIGITS))
    if isinstance(v, decimal.Decimal):
        return repr(float(v) if DIGITS is None else round(float(v), DIGITS))
    if isinstance(v, bool):
        return str(int(v))
    if isinstance(v, int):
        return repr(float(v))
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    if isinstance(v, dt.date):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return "[" + ",".join(str(_norm(x)) for x in v) + "]"
    return str(v)


def digest(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted("|".join(str(_norm(r[i])) for i in order) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return [columns[i] for i in order], lines, h


DUCK_TO_SPARK = {"BIGINT": "bigint", "INTEGER": "int", "DOUBLE": "double", "VARCHAR": "string",
                 "DATE": "date", "TIMESTAMP": "timestamp_ntz", "BOOLEAN": "boolean"}


def type_mismatches(spark_df, sql: str, sf_dir: str) -> dict:
    """Columns whose Spark type differs from the DuckDB result type."""
    con = duck(sf_dir)
    d = {r[0]: DUCK_TO_SPARK.get(str(r[1]), str(r[1])) for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    s = dict(spark_df.dtypes)
    return {c: (s.get(c), d.get(c)) for c in set(s) | set(d) if s.get(c) != d.get(c)}


def compare(spark_df, sql: str, sf_dir: str, show: int = 5):
    s_cols = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    con = duck(sf_dir)
    res = con.execute(sql)
    d_cols = [c[0] for c in res.description]
    d_rows = res.fetchall()
    sc, sl, sh = digest(s_cols, s_rows)
    dc, dl, dh = digest(d_cols, d_rows)
    ok = sc == dc and len(sl) == len(dl) and sh == dh
    info = {"ok": ok, "spark_rows": len(sl), "duck_rows": len(dl), "cols_equal": sc == dc}
    if not ok:
        info["spark_cols"], info["duck_cols"] = sc, dc
        a, b = set(sl), set(dl)
        info["only_spark"] = sorted(a - b)[:show]
        info["only_duck"] = sorted(b - a)[:show]
    return info
