"""Cutoff-date expressions.

A cutoff is a DATE; order timestamps are TIMESTAMP_NTZ.  Comparing them
means comparing with midnight of the cutoff day, so an order at 00:00:01 on
the cutoff day is already in the future.  The literals below constant-fold,
so the comparisons reach the Parquet scan as pushed filters.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

LABEL_HORIZON_DAYS = 90


def as_date(value) -> dt.date:
    if isinstance(value, dt.datetime):
        return value.date()
    if isinstance(value, dt.date):
        return value
    return dt.date.fromisoformat(str(value))


def label_window_end(cutoff, horizon_days: int = LABEL_HORIZON_DAYS) -> Column:
    """Midnight of cutoff + horizon days (inclusive upper bound)."""
    return F.lit(as_date(cutoff) + dt.timedelta(days=horizon_days)).cast("timestamp_ntz")


def days_between(later: Column, earlier: Column) -> Column:
    """Whole days later - earlier as BIGINT (SQL `date - date`)."""
    return F.datediff(later, earlier).cast("long")
