"""Column-expression helpers (all built-in Spark functions, JVM-side)."""

from pitstop.functions.dates import as_date, days_between, label_window_end
from pitstop.functions.exprs import cap, clamp, null_field_names, nonneg_or_null, psi_verdict, threshold

__all__ = ["as_date", "days_between", "label_window_end", "cap", "clamp", "null_field_names", "nonneg_or_null",
           "psi_verdict", "threshold"]
