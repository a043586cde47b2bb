"""Feature cleaning (dataset side) and training-row preparation.

The two keep the reference's different NULL policies: the dataset job
fills NULLs with constants, training drops incomplete rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitstop.functions.exprs import cap
from pitstop.sources.schemas import FEATURE_COLUMNS, KEY_COLUMN, LABEL_COLUMN

# Fill constants and the recency cap.
RECENCY_FILL = 9999
RECENCY_CAP = 730
FILL_VALUES = {"total_spend": 0.0, "distinct_products": 0, "order_count": 0,
               "tenure_days": 0, "churned": 0}


def _num(df: DataFrame, c: str):
    """NaN is a missing value in a floating column; integers stay exact."""
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        return F.nanvl(F.col(c), F.lit(None).cast("double"))
    return F.col(c)


def transform_features(df: DataFrame, recency_cap: int = RECENCY_CAP) -> DataFrame:
    """Fill missing values, cap recency, cast counts to integers.  Other
    columns pass through unchanged and the row count is kept."""
    kinds = {"recency_days": "long", "total_spend": "double", "churned": "int"}

    def filled(c):
        if c == "recency_days":
            return F.least(F.coalesce(_num(df, c), F.lit(RECENCY_FILL)), F.lit(recency_cap)).cast("long")
        return F.coalesce(_num(df, c), F.lit(FILL_VALUES[c])).cast(kinds.get(c, "long"))

    names = {"recency_days", *FILL_VALUES}
    return df.select(*[filled(c).alias(c) if c in names else F.col(c) for c in df.columns])


def training_rows(df: DataFrame, recency_cap: int = RECENCY_CAP) -> DataFrame:
    """Drop rows with a NULL (or NaN) feature or label, then cap recency.
    Dropping first matters: `least` would silently turn NULL into the cap."""
    cols = FEATURE_COLUMNS + [LABEL_COLUMN]
    keep = F.lit(True)
    for c in cols:
        keep = keep & _num(df, c).isNotNull()
    return (df.where(keep)
            .select(KEY_COLUMN, *[
                cap(F.col(c), recency_cap).alias(c) if c == "recency_days" else F.col(c)
                for c in FEATURE_COLUMNS], LABEL_COLUMN))
