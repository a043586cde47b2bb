"""Point-in-time feature and label table (one row per customer and cutoff).

Contract (all cutoffs are DATEs, order timestamps TIMESTAMP_NTZ):

* past orders: ``order_date <= cutoff`` (midnight), any status;
* label window: ``cutoff < order_date <= cutoff + 90 days`` and
  ``status = 'completed'``;
* NULL order dates fall out of both sides;
* an order without items counts in ``order_count`` but adds no product.

Physical shape of :func:`feature_table` (single cutoff): one scan of
``orders`` bounded by ``cutoff + 90d`` feeding a single grouped pass with
conditional aggregates (past count / max / sum and the label count), a
second narrow scan of past orders joined to items for the distinct-product
count, and the customer table left-joined to both on ``customer_id``.  Hot
customers are absorbed by partial (map-side) aggregation before every
shuffle; the only row-level join is on ``order_id``.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

import datetime as dt

from pitstop.functions.dates import (LABEL_HORIZON_DAYS, as_date, days_between,
                                     label_window_end)
from pitstop.functions.exprs import count_below

RECENCY_IF_NO_ORDER = 9999
COMPLETED = "completed"

FEATURE_TABLE_COLUMNS = ["customer_id", "signup_date", "country", "order_count",
                         "last_order_date", "total_spend", "distinct_products", "recency_days",
                         "tenure_days", "orders_next_90d", "churned"]


def ts_sql(day) -> str:
    """Midnight of a day as a TIMESTAMP_NTZ SQL literal."""
    return f"TIMESTAMP_NTZ '{as_date(day).isoformat()} 00:00:00'"


def end_sql(cutoff, horizon_days: int = LABEL_HORIZON_DAYS) -> str:
    return ts_sql(as_date(cutoff) + dt.timedelta(days=horizon_days))


def money_units_sql(df: DataFrame, col: str = "order_total") -> tuple[str, float | None]:
    """SQL text of :func:`money_units`."""
    t = df.schema[col].dataType
    if isinstance(t, T.DecimalType) and t.precision <= 18:
        return f"CAST({col} * {10 ** t.scale} AS BIGINT)", float(10 ** t.scale)
    return col, None


def money_units(df: DataFrame, col: str = "order_total") -> tuple[Column, float | None]:
    """Exact integer units of a money column for fast summing.

    A DECIMAL(p, s) with p <= 18 is summed as a BIGINT count of 10^-s units
    (a long-backed aggregate instead of BigDecimal); ``units / 10^s`` is
    the same double as casting the exact decimal sum (both round the exact
    quotient once) while the sum stays below 2^53 units.  Other types are
    summed as they are.  Overflow fails the job (ANSI), never wraps."""
    t = df.schema[col].dataType
    if isinstance(t, T.DecimalType) and t.precision <= 18:
        return (F.col(col) * F.lit(10 ** t.scale)).cast("long"), float(10 ** t.scale)
    return F.col(col), None


def _to_money_double(total: Column, factor: float | None) -> Column:
    return total.cast("double") if factor is None else total / F.lit(factor)


def past_orders(orders: DataFrame, cutoff) -> DataFrame:
    """Orders placed up to midnight of the cutoff day (any status)."""
    return (orders.where(f"order_date <= {ts_sql(cutoff)}")
            .select("customer_id", "order_id", "order_date", "order_total"))


def future_orders(orders: DataFrame, cutoff, horizon_days: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """Completed orders per customer in ``(cutoff, cutoff + horizon]``."""
    return (orders.where(f"order_date > {ts_sql(cutoff)} AND order_date <= "
                         f"{end_sql(cutoff, horizon_days)} AND status = '{COMPLETED}'")
            .groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("orders_next_90d")))


def past_agg(orders: DataFrame, cutoff) -> DataFrame:
    """order_count, last_order_date, total_spend over past orders."""
    units, factor = money_units(orders)
    po = past_orders(orders, cutoff).withColumn("_units", units)
    return (po.groupBy("customer_id")
            .agg(F.count(F.lit(1)).alias("order_count"),
                 F.max("order_date").alias("last_order_date"),
                 F.coalesce(_to_money_double(F.sum("_units"), factor), F.lit(0.0)).alias("total_spend")))


def past_products(orders: DataFrame, items: DataFrame, cutoff) -> DataFrame:
    """Distinct products bought in past orders, per customer (inner join:
    item-less orders contribute nothing)."""
    po = past_orders(orders, cutoff).select("order_id", "customer_id")
    return (po.join(items.select("order_id", "product_id"), "order_id")
            .groupBy("customer_id")
            .agg(F.count_distinct("product_id").alias("distinct_products")))


def churn_label(orders_next: Column) -> Column:
    return F.when(F.coalesce(orders_next, F.lit(0)) == 0, F.lit(1)).otherwise(F.lit(0))


def _finish(cust: DataFrame, cutoff, order_count: str, last_order: str, spend: str,
            products: str, future: str) -> DataFrame:
    """Common projection of the feature contract (COALESCE defaults,
    recency/tenure day counts, label); arguments are column names or SQL."""
    c = f"DATE '{as_date(cutoff).isoformat()}'"
    return cust.selectExpr(
        "customer_id", "signup_date", "country",
        f"CAST(COALESCE({order_count}, 0) AS BIGINT) AS order_count",
        f"{last_order} AS last_order_date",
        f"COALESCE(CAST({spend} AS DOUBLE), 0.0) AS total_spend",
        f"CAST(COALESCE({products}, 0) AS BIGINT) AS distinct_products",
        f"CAST(COALESCE(datediff({c}, CAST({last_order} AS DATE)), {RECENCY_IF_NO_ORDER}) AS BIGINT)"
        " AS recency_days",
        f"CAST(datediff({c}, signup_date) AS BIGINT) AS tenure_days",
        f"CAST(COALESCE({future}, 0) AS BIGINT) AS orders_next_90d",
        f"CASE WHEN COALESCE({future}, 0) = 0 THEN 1 ELSE 0 END AS churned",
    )


def feature_table(customers: DataFrame, orders: DataFrame, items: DataFrame, cutoff,
                  horizon_days: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """Fused plan: 2 order scans, 1 item scan, 1 customer scan."""
    cut, end = ts_sql(cutoff), end_sql(cutoff, horizon_days)
    units, factor = money_units_sql(orders)
    spend = f"sum(CASE WHEN order_date <= {cut} THEN {units} END)"
    spend = spend if factor is None else f"{spend} / {factor!r}D"
    per_customer = (orders.where(f"order_date <= {end}")
                    .groupBy("customer_id")
                    .agg(F.expr(f"count_if(order_date <= {cut})").alias("_n_past"),
                         F.expr(f"max(CASE WHEN order_date <= {cut} THEN order_date END)").alias("_last"),
                         F.expr(spend).alias("_spend"),
                         F.expr(f"count_if(order_date > {cut} AND status = '{COMPLETED}')")
                         .alias("_n_future")))
    products = past_products(orders, items, cutoff)
    joined = (customers.select("customer_id", "signup_date", "country")
              .join(per_customer, "customer_id", "left")
              .join(products, "customer_id", "left"))
    return _finish(joined, cutoff, "_n_past", "_last", "_spend", "distinct_products", "_n_future")


def feature_table_grouped(customers: DataFrame, orders: DataFrame, items: DataFrame, cutoff,
                          horizon_days: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """The three-aggregate form (past_agg, past_products, future_orders)
    left-joined to customers, as written in the grouped SQL."""
    joined = (customers.select("customer_id", "signup_date", "country")
              .join(past_agg(orders, cutoff), "customer_id", "left")
              .join(past_products(orders, items, cutoff), "customer_id", "left")
              .join(future_orders(orders, cutoff, horizon_days), "customer_id", "left"))
    return _finish(joined, cutoff, "order_count", "last_order_date", "total_spend",
                   "distinct_products", "orders_next_90d")


def customer_sample(features_fn, customers: DataFrame, orders: DataFrame, items: DataFrame,
                    cutoff, max_customer_id: int) -> DataFrame:
    """Key-range sample ``customer_id <= k`` pushed into every input."""
    keep = F.col("customer_id") <= F.lit(max_customer_id)
    return features_fn(customers.where(keep), orders.where(keep), items, cutoff)


def _cutoff_list(cutoffs: Iterable) -> list:
    cs = sorted({as_date(c) for c in cutoffs})
    if not cs:
        raise ValueError("at least one cutoff is required")
    return cs


def first_purchases(orders: DataFrame, items: DataFrame, cutoffs: Iterable, keys: list[str]) -> DataFrame:
    """(keys..., product_id, idx): each product that a key's orders bring in, once,
    with the number of the first cutoff (ascending, from 0) that counts it.  The
    distinct products of cutoff k are the rows with ``idx <= k``, so no row is
    copied for a cutoff.  Orders without a date or beyond the last cutoff, and
    items without a product, count nowhere."""
    midnights = [F.lit(c).cast("timestamp_ntz") for c in _cutoff_list(cutoffs)]
    d = F.col("order_date")
    dated = orders.where(d.isNotNull() & (d <= midnights[-1])).select("order_id", *keys, count_below(d, midnights).alias("idx"))
    return (dated.join(items.where(F.col("product_id").isNotNull()).select("order_id", "product_id"), "order_id")
            .groupBy(*keys, "product_id").agg(F.min("idx").alias("idx")))


def multi_cutoff_features(customers: DataFrame, orders: DataFrame, items: DataFrame,
                          cutoffs: Iterable, horizon_days: int = LABEL_HORIZON_DAYS) -> DataFrame:
    """Feature table for many cutoffs at once (rolling-origin backtests),
    with a ``cutoff_date`` column.

    Orders and items are not copied per cutoff.  With cutoffs c_0 < ... < c_{K-1}:

    * each order is assigned to the first cutoff it precedes
      (``idx = #{c_i < order_date}``); per (customer, idx) partial counts,
      sums and maxima become the features of cutoff k through running
      sums / maxima over idx <= k;
    * a (customer, product) pair counts from the first idx it was bought;
    * a completed order lies in the label windows of a contiguous idx
      range [lo, hi]; it emits +1 at lo and -1 at hi + 1 and a running
      sum yields ``orders_next_90d``.

    Orders and items are shuffled once whatever K is; beside them travel at
    most a few partials per (customer, cutoff).  The |customers| x K result
    rows are made behind the last exchange, from one array per customer.
    """
    cs = _cutoff_list(cutoffs)
    k = len(cs)
    # DATE literals cast to TIMESTAMP_NTZ: midnight, independent of any time zone
    # (a naive Python datetime literal would be read in the driver's zone)
    midnights = [F.lit(c).cast("timestamp_ntz") for c in cs]
    d = F.col("order_date")
    # index of the first cutoff at/after the order (#cutoffs strictly before it)
    first_idx = count_below(d, midnights)
    # first cutoff whose label window reaches the order: c >= d - horizon
    horizon = F.expr(f"INTERVAL '{int(horizon_days)}' DAY")
    window_lo = count_below(d - horizon, midnights)

    units, factor = money_units(orders)
    o = (orders.where(d.isNotNull() & (d <= label_window_end(cs[-1], horizon_days)))
         .select("customer_id", "order_id", "order_date", "status", units.alias("_units"))
         .withColumn("idx", first_idx))

    # One record stream from one scan: an order's past partial at its first
    # cutoff index, and (completed orders) +1 / -1 at the ends of its label
    # window range; one partially aggregated groupBy reduces all of them.
    rec = "struct<idx:int,n_orders:bigint,spend:{u},last_date:timestamp_ntz,delta:int>"
    utype = o.schema["_units"].dataType.simpleString()
    rec = rec.format(u=utype)
    o2 = o.select("customer_id", "idx", "_units", "order_date", "status",
                  window_lo.alias("lo"), (F.col("idx") - 1).alias("hi"))
    windowed = (F.col("status") == COMPLETED) & (F.col("lo") <= F.col("hi"))
    recs = F.array(
        F.when(F.col("idx") < k, F.struct(F.col("idx").cast("int").alias("idx"),
                                           F.lit(1).cast("bigint").alias("n_orders"),
                                           F.col("_units").alias("spend"),
                                           F.col("order_date").alias("last_date"),
                                           F.lit(0).alias("delta"))),
        F.when(windowed, F.struct(F.col("lo").cast("int").alias("idx"),
                                  F.lit(0).cast("bigint").alias("n_orders"),
                                  F.lit(None).cast(utype).alias("spend"),
                                  F.lit(None).cast("timestamp_ntz").alias("last_date"),
                                  F.lit(1).alias("delta"))),
        F.when(windowed & (F.col("hi") + 1 < k), F.struct((F.col("hi") + 1).cast("int").alias("idx"),
                                                          F.lit(0).cast("bigint").alias("n_orders"),
                                                          F.lit(None).cast(utype).alias("spend"),
                                                          F.lit(None).cast("timestamp_ntz").alias("last_date"),
                                                          F.lit(-1).alias("delta"))))
    partials = (o2.select("customer_id", F.explode(F.filter(recs.cast(f"array<{rec}>"),
                                                            lambda r: r.isNotNull())).alias("r"))
                .groupBy("customer_id", F.col("r.idx").alias("idx"))
                .agg(F.sum("r.n_orders").alias("n_orders"), F.sum("r.spend").alias("spend"),
                     F.max("r.last_date").alias("last_date"), F.sum("r.delta").alias("delta")))

    first_buy = (o.where(F.col("idx") < k).select("order_id", "customer_id", "idx")
                 .join(items.select("order_id", "product_id").where(F.col("product_id").isNotNull()),
                       "order_id")
                 .groupBy("customer_id", "product_id").agg(F.min("idx").alias("idx"))
                 .groupBy("customer_id", "idx").agg(F.count(F.lit(1)).alias("new_products")))

    # A row a customer until after the last exchange: the partials of a
    # customer (a few for each cutoff at most) travel as one array, and the
    # rows per cutoff are made from it in place.
    money = partials.schema["spend"].dataType.simpleString()
    part = ("CAST(named_struct('idx', {}, 'n_orders', {}, 'spend', {}, 'last_date', {}, 'delta', {}, 'new_products', {}) AS "
            f"struct<idx:int,n_orders:bigint,spend:{money},last_date:timestamp_ntz,delta:bigint,new_products:bigint>) AS e")
    history = (partials.selectExpr("customer_id", part.format("idx", "n_orders", "spend", "last_date", "delta", "0"))
               .union(first_buy.selectExpr("customer_id", part.format("idx", "0", "NULL", "NULL", "0", "new_products")))
               .groupBy("customer_id").agg(F.collect_list("e").alias("_parts")))
    # One fold a customer: the running totals behind each partial, in order,
    # from nothing at index 0; each holds until the next one's index.
    zero = (f"array(CAST(named_struct('idx', 0, 'n', 0L, 'spend', NULL, 'last', NULL, 'products', 0L, 'delta', 0L) AS "
            f"struct<idx:int,n:bigint,spend:{money},last:timestamp_ntz,products:bigint,delta:bigint>))")
    then = (f"named_struct('idx', e.idx, 'n', element_at(a, -1).n + e.n_orders, 'spend', CAST(coalesce(element_at(a, -1).spend + e.spend, "
            f"element_at(a, -1).spend, e.spend) AS {money}), 'last', greatest(element_at(a, -1).last, e.last_date), "
            "'products', element_at(a, -1).products + e.new_products, 'delta', element_at(a, -1).delta + e.delta)")
    totals = f"aggregate(sort_array(coalesce(_parts, array())), {zero}, (a, e) -> concat(a, array({then})))"
    lasting = f"transform(_t, (x, i) -> named_struct('t', x, 'until', coalesce(get(_t, i + 1).idx, {k})))"
    dates = "array(" + ", ".join(f"DATE '{c.isoformat()}'" for c in cs) + ")"
    cum = (customers.select("customer_id", "signup_date", "country").join(history, "customer_id", "left")
           .selectExpr("customer_id", "signup_date", "country", f"{totals} AS _t")
           .selectExpr("customer_id", "signup_date", "country", f"inline({lasting})").where("t.idx < until")
           .selectExpr("customer_id", "signup_date", "country", "t", "explode(sequence(t.idx, until - 1)) AS _k")
           .selectExpr("customer_id", "signup_date", "country", f"{dates}[_k] AS cutoff_date", "t.n AS _n_past", "t.last AS _last",
                       "t.spend AS _spend", "t.products AS _products", "t.delta AS _n_future"))
    cut = F.col("cutoff_date")
    return cum.select(
        "cutoff_date", "customer_id", "signup_date", "country",
        F.coalesce(F.col("_n_past"), F.lit(0)).cast("long").alias("order_count"),
        F.col("_last").alias("last_order_date"),
        F.coalesce(_to_money_double(F.col("_spend"), factor), F.lit(0.0)).alias("total_spend"),
        F.coalesce(F.col("_products"), F.lit(0)).cast("long").alias("distinct_products"),
        F.coalesce(days_between(cut, F.to_date("_last")),
                   F.lit(RECENCY_IF_NO_ORDER)).cast("long").alias("recency_days"),
        days_between(cut, F.col("signup_date")).alias("tenure_days"),
        F.coalesce(F.col("_n_future"), F.lit(0)).cast("long").alias("orders_next_90d"),
        churn_label(F.col("_n_future")).alias("churned"),
    )
