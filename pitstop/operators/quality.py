"""Data-quality operators.

``validate_report`` evaluates every dataset check in one aggregate pass
(plus one key-uniqueness aggregation) and returns one row per check:
``(check, passed, n_bad, value, rule)``.  ``validate`` raises on any failed
row.  The table profiles (NULL rates, duplicate natural keys, orphaned
foreign keys) are the checks the schema's constraints would have made.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from pitstop.sources.schemas import KEY_COLUMN, REQUIRED_COLUMNS

MAX_NULL_FRACTION = 0.01

REPORT_SCHEMA = "check string, passed boolean, n_bad bigint, value double, rule string"


class ValidationError(AssertionError):
    """Raised by :func:`validate`; carries the failed report rows."""

    def __init__(self, failed):
        self.failed = failed
        super().__init__("; ".join(f"{r['check']} failed ({r['rule']}; n_bad={r['n_bad']})"
                                   for r in failed))


def _is_missing(df: DataFrame, c: str):
    t = df.schema[c].dataType
    if isinstance(t, (T.DoubleType, T.FloatType)):
        return F.col(c).isNull() | F.isnan(F.col(c))
    return F.col(c).isNull()


def _nonneg_fails(df: DataFrame, c: str):
    ok = F.col(c) >= 0
    if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)):
        ok = ok & ~F.isnan(F.col(c))
    return ~F.coalesce(ok, F.lit(False))


def validate_report(df: DataFrame, key: str | Sequence[str] = KEY_COLUMN,
                    required: Sequence[str] = tuple(REQUIRED_COLUMNS),
                    max_null_fraction: float = MAX_NULL_FRACTION) -> DataFrame:
    """``key`` is a column or a list of columns, as a frame of several cutoffs
    needs.  A NULL in the key is a value like any other."""
    spark = df.sparkSession
    keys = [key] if isinstance(key, str) else list(key)
    has_key = all(k in df.columns for k in keys)
    named = ", ".join(keys)
    missing = [c for c in required if c not in df.columns]
    present = [c for c in required if c in df.columns]
    rows = [F.struct(F.lit("required_columns").alias("check"),
                     F.lit(not missing).alias("passed"),
                     F.lit(len(missing)).cast("long").alias("n_bad"),
                     F.lit(float(len(missing))).alias("value"),
                     F.lit("all required columns present").alias("rule"))]

    # Per-row checks are counted per key first, then summed: one shuffle on
    # the key (partial aggregation absorbs hot keys) serves both the
    # uniqueness check and every other count.
    per_row = [("bad_order_count", _nonneg_fails(df, "order_count"))
               if "order_count" in df.columns else None,
               ("bad_total_spend", _nonneg_fails(df, "total_spend"))
               if "total_spend" in df.columns else None,
               ("bad_churned", ~F.coalesce(F.col("churned").isin(0, 1), F.lit(False)))
               if "churned" in df.columns else None]
    per_row = [p for p in per_row if p is not None]
    per_row += [(f"null_{i}", _is_missing(df, c)) for i, c in enumerate(present)]
    grouped = df.groupBy(*(keys if has_key else [])).agg(F.count(F.lit(1)).alias("_n"),
                                         *[F.count_if(e).alias(a) for a, e in per_row])
    stats = grouped.agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_rows"),
                        F.coalesce(F.sum(F.when(F.col("_n") > 1, F.col("_n") - 1)), F.lit(0))
                        .cast("long").alias("dup_rows"),
                        *[F.coalesce(F.sum(a), F.lit(0)).cast("long").alias(a)
                          for a, _ in per_row])
    n = F.col("n_rows")

    def check(name, bad, rule, value=None, passed=None):
        bad = bad.cast("long")
        return F.struct(F.lit(name).alias("check"),
                        (bad == 0 if passed is None else passed).alias("passed"),
                        bad.alias("n_bad"),
                        (bad.cast("double") if value is None else value).alias("value"),
                        F.lit(rule).alias("rule"))

    def absent(name, rule):
        return F.struct(F.lit(name).alias("check"), F.lit(False).alias("passed"),
                        F.lit(None).cast("long").alias("n_bad"),
                        F.lit(None).cast("double").alias("value"),
                        F.lit(rule + " (column missing)").alias("rule"))

    rows.append(check("key_unique", F.col("dup_rows"), f"{named} unique")
                if has_key else absent("key_unique", f"{named} unique"))
    for col, name, rule in [("order_count", "order_count_nonneg", "order_count >= 0"),
                            ("total_spend", "total_spend_nonneg", "total_spend >= 0"),
                            ("churned", "churned_binary", "churned in (0, 1)")]:
        rows.append(check(name, F.col(f"bad_{col}"), rule) if col in df.columns
                    else absent(name, rule))
    rows.append(check("non_empty", F.when(n == 0, 1).otherwise(0), "at least one row",
                      value=n.cast("double")))
    if present:
        worst = F.greatest(*[F.col(f"null_{i}") for i in range(len(present))], F.lit(0))
        frac = F.when(n > 0, worst / n).otherwise(F.lit(0.0))
        rows.append(check("null_fraction", worst,
                          f"max NULL fraction over required columns < {max_null_fraction}",
                          value=frac, passed=frac < max_null_fraction))
    out = stats.select(F.explode(F.array(*[r for r in rows[1:]])).alias("r")).select("r.*")
    head = spark.range(1).select(rows[0].alias("r")).select("r.*")
    return head.unionByName(out)


def validate(df: DataFrame, **kw) -> DataFrame:
    """Raise :class:`ValidationError` if any check fails; return the report."""
    found = [r.asDict() for r in validate_report(df, **kw).collect()]   # a row a check
    failed = [r for r in found if not r["passed"]]
    if failed:
        raise ValidationError(failed)
    return df.sparkSession.createDataFrame(found, REPORT_SCHEMA)


# ------------------------------------------------------------ table profiles

def null_rates(df: DataFrame, table_name: str) -> DataFrame:
    """One pass: per column NULL count and rate -> (table, column, n_rows,
    n_null, null_rate)."""
    cols = df.columns
    agg = df.agg(F.count(F.lit(1)).alias("n_rows"),
                 *[F.count_if(_is_missing(df, c)).alias(f"c{i}") for i, c in enumerate(cols)])
    pairs = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"c{i}").alias("n_null"))
                      for i, c in enumerate(cols)])
    return (agg.select("n_rows", F.explode(pairs).alias("p"))
            .select(F.lit(table_name).alias("table_name"), "p.column_name", "n_rows", "p.n_null",
                    F.when(F.col("n_rows") > 0, F.col("p.n_null") / F.col("n_rows"))
                    .otherwise(F.lit(0.0)).alias("null_rate")))


def duplicate_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Natural-key values held by more than one row -> keys + n_rows."""
    return (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n_rows"))
            .where(F.col("n_rows") > 1))


def dedup_keep_lowest(df: DataFrame, keys: Sequence[str], id_col: str) -> DataFrame:
    """Keep, per natural key, the row with the lowest surrogate id (ties on
    the id are broken by the remaining columns in column order).

    An aggregate of ``min(struct(id, ...))`` instead of a ``row_number``
    window: partial aggregation collapses duplicates map-side, so a hot key
    never reaches one task as a full group."""
    rest = [c for c in df.columns if c not in keys]
    if id_col not in rest:
        raise ValueError(f"{id_col} must be a non-key column")
    ordered = [id_col] + [c for c in rest if c != id_col]
    return (df.groupBy(*keys).agg(F.min(F.struct(*ordered)).alias("_r"))
            .select(*keys, *[F.col(f"_r.{c}").alias(c) for c in ordered])
            .select(*df.columns))


def fk_orphans(child: DataFrame, fk: str, parent: DataFrame, pk: str, relation: str) -> DataFrame:
    """Rows whose non-NULL foreign key has no parent -> one summary row
    (relation, n_checked, n_orphans).  Child keys are counted before the
    join, so a hot key arrives as one pre-aggregated row."""
    keys = (child.where(F.col(fk).isNotNull()).groupBy(F.col(fk).alias("_k"))
            .agg(F.count(F.lit(1)).alias("_n")))
    parents = parent.select(F.col(pk).alias("_k")).distinct().withColumn("_hit", F.lit(True))
    return (keys.join(parents, "_k", "left")
            .agg(F.coalesce(F.sum("_n"), F.lit(0)).cast("long").alias("n_checked"),
                 F.coalesce(F.sum(F.when(F.col("_hit").isNull(), F.col("_n"))), F.lit(0))
                 .cast("long").alias("n_orphans"))
            .select(F.lit(relation).alias("relation"), "n_checked", "n_orphans"))


def union_all(frames: Sequence[DataFrame]) -> DataFrame:
    return reduce(lambda a, b: a.unionByName(b), frames)
