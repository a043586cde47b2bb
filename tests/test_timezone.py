"""Cutoff logic must not depend on the driver's time zone: run the
multi-cutoff vs single-cutoff comparison in a fresh process whose local
zone is not UTC."""

import os
import subprocess
import sys

SCRIPT = r'''
import datetime as dt, sys, tempfile
sys.path.insert(0, sys.argv[1])
sys.path.insert(0, sys.argv[1] + "/tests")
from fixtures import C, edge_tables
from pyspark.sql import functions as F
from pitstop.session import build_session
from pitstop.operators import features as ft
spark = build_session(master="local[2]", extra={"spark.checkpoint.dir": tempfile.mkdtemp()})
# orders at 00:00:00 / 00:00:01 around the cutoff: a shifted literal shows
c, o, i = edge_tables(spark)
cuts = [C, C + dt.timedelta(days=5), dt.date(2025, 12, 1)]
m = ft.multi_cutoff_features(c, o, i, cuts)
bad = 0
for d in cuts:
    s = ft.feature_table(c, o, i, d).withColumn("cutoff_date", F.lit(d)).select(m.columns)
    p = m.where(F.col("cutoff_date") == d)
    bad += p.exceptAll(s).count() + s.exceptAll(p).count()
print("MISMATCHES", bad)
'''


def test_cutoffs_independent_of_driver_time_zone():
    root = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    env = dict(os.environ, TZ="America/New_York")
    out = subprocess.run([sys.executable, "-c", SCRIPT, root], env=env, capture_output=True,
                         text=True, timeout=600)
    assert "MISMATCHES 0" in out.stdout, out.stdout[-2000:] + out.stderr[-2000:]
