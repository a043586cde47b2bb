"""Scalar helpers shared by operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def cap(col: Column, upper) -> Column:
    """Upper clip that keeps NULL as NULL (`least` alone would turn NULL
    into the cap)."""
    return F.when(col.isNull(), None).otherwise(F.least(col, F.lit(upper)))


def clamp(col: Column, lower=0.0, upper=1.0) -> Column:
    return F.when(col.isNull(), None).otherwise(F.greatest(F.lit(lower), F.least(F.lit(upper), col)))


def threshold(col: Column, cut: float = 0.5) -> Column:
    return (col >= F.lit(cut)).cast("int")


def nonneg_or_null(col: Column) -> Column:
    """Request-field rule: NULL or >= 0 (NaN is rejected)."""
    return col.isNull() | (~F.isnan(col.cast("double")) & (col >= 0))


def null_field_names(names: Sequence[str]) -> Column:
    """Names of the NULL fields among `names`, in the given order."""
    tagged = F.array(*[F.when(F.col(n).isNull(), F.lit(n)) for n in names])
    return F.filter(tagged, lambda x: x.isNotNull())


def psi_verdict(psi: Column, investigate: float = 0.1, retrain: float = 0.25) -> Column:
    return (F.when(psi.isNull(), F.lit("NO_DATA"))
            .when(psi < investigate, F.lit("OK"))
            .when(psi < retrain, F.lit("INVESTIGATE"))
            .otherwise(F.lit("RETRAIN")))


def count_below(value: Column, sorted_values, strict: bool = True) -> Column:
    """Number of ``sorted_values`` (ascending literals) below ``value``
    (``<`` when strict, else ``<=``): a balanced CASE tree of depth
    log2(n + 1).  ``value`` must be non-NULL."""
    vals = list(sorted_values)
    def node(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        v = vals[mid] if isinstance(vals[mid], Column) else F.lit(vals[mid])
        below = (v < value) if strict else (v <= value)
        return F.when(below, node(mid + 1, hi)).otherwise(node(lo, mid))
    return node(0, len(vals))


# ---- SQL-text builders: one F.expr call instead of one py4j call per node

def sql_double(x: float) -> str:
    x = float(x)
    if x != x:
        return "CAST('NaN' AS DOUBLE)"
    if x in (float("inf"), float("-inf")):
        return f"CAST('{'-' if x < 0 else ''}Infinity' AS DOUBLE)"
    return repr(x) + "D"
