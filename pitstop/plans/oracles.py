"""DuckDB twins of the registered queries (the correctness gate).

They read the raw driver tables (pre-registered DuckDB views) through the
same mapping as :mod:`pitstop.sources.tables` (``ORACLE_CTES``)."""

from __future__ import annotations

import datetime as dt

from pitstop.functions.dates import as_date
from pitstop.sources.dirty import DIRTY_CTES
from pitstop.sources.tables import ORACLE_CTES


def _d(x) -> str:
    return as_date(x).isoformat()


def _end(cutoff, horizon=90) -> str:
    return (as_date(cutoff) + dt.timedelta(days=horizon)).isoformat()


def feature_ctes(cutoff, horizon=90, sfx: str = "", base: bool = True) -> str:
    """The feature contract, derived another way than the Spark plans: every
    customer's orders are one list with their distance to the cutoff in
    microseconds, and the features are read off the lists.  Money is summed in
    cents; products are counted over the grouped (customer, product) pairs."""
    head = f"{ORACLE_CTES}," if base else ""
    return _suffix(f"""{head}
timeline AS (
    SELECT *, epoch_us(order_date) - epoch_us(TIMESTAMP '{_d(cutoff)} 00:00:00') AS away FROM m_orders
),
histories AS (
    SELECT customer_id, list({{'on': order_date, 'cents': CAST(order_total * 100 AS BIGINT)}}) FILTER (away <= 0) AS past,
           list(order_id) FILTER (away BETWEEN 1 AND {horizon} * 86400000000 AND status = 'completed') AS ahead
    FROM timeline GROUP BY customer_id
),
baskets AS (
    SELECT customer_id, len(list(product_id)) AS kinds
    FROM (SELECT t.customer_id, i.product_id FROM m_items i, timeline t
          WHERE i.order_id = t.order_id AND t.away <= 0 GROUP BY ALL)
    WHERE product_id IS NOT NULL GROUP BY customer_id
),
features AS (
    SELECT customer_id, signup_date, country, CAST(ifnull(len(past), 0) AS BIGINT) AS order_count,
           list_max([x."on" for x in past]) AS last_order_date,
           CAST(ifnull(list_sum([x.cents for x in past]), 0) AS DOUBLE) / 100 AS total_spend,
           CAST(ifnull(kinds, 0) AS BIGINT) AS distinct_products,
           CAST(ifnull(date_diff('day', list_max([x."on" for x in past]), TIMESTAMP '{_d(cutoff)} 00:00:00'), 9999)
                AS BIGINT) AS recency_days,
           CAST(date_diff('day', signup_date, DATE '{_d(cutoff)}') AS BIGINT) AS tenure_days,
           CAST(ifnull(len(ahead), 0) AS BIGINT) AS orders_next_90d,
           CASE WHEN len(ahead) > 0 THEN 0 ELSE 1 END AS churned
    FROM m_customers LEFT JOIN histories USING (customer_id) LEFT JOIN baskets USING (customer_id)
)""", sfx)


_CTE_NAMES = ("timeline", "histories", "baskets", "features", "transformed")


def _suffix(sql: str, sfx: str) -> str:
    if not sfx:
        return sql
    import re
    for n in _CTE_NAMES:
        sql = re.sub(rf"\b{n}\b", n + sfx, sql)
    return sql


def feature_table(cutoff) -> str:
    return f"WITH {feature_ctes(cutoff)} SELECT * FROM features"


def feature_table_correlated(cutoff) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT customer_id, signup_date, country, order_count, "
            "last_order_date, total_spend, distinct_products, orders_next_90d FROM features")


def past_orders(cutoff) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT customer_id, order_id, order_date, "
            "CAST(order_total AS DOUBLE) AS order_total FROM timeline WHERE away <= 0")


def past_agg(cutoff) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT customer_id, order_count, last_order_date, total_spend "
            "FROM features WHERE order_count > 0")


def past_products(cutoff) -> str:
    return f"WITH {feature_ctes(cutoff)} SELECT customer_id, distinct_products FROM features WHERE distinct_products > 0"


def future_orders(cutoff) -> str:
    return f"WITH {feature_ctes(cutoff)} SELECT customer_id, orders_next_90d FROM features WHERE orders_next_90d > 0"


def churn_label(cutoff) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT customer_id, orders_next_90d, churned FROM features")


def customer_sample(cutoff, k) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT * FROM features WHERE customer_id <= {int(k)}")


def multi_cutoff(cutoffs) -> str:
    parts = []
    for c in cutoffs:
        parts.append(f"(WITH {feature_ctes(c)} SELECT DATE '{_d(c)}' AS cutoff_date, * FROM features)")
    return "\nUNION ALL\n".join(parts)


def incremental_backtest(cutoffs) -> str:
    """The last two cutoffs over the orders that had arrived by then."""
    due = "CASE " + " ".join(f"WHEN order_date <= TIMESTAMP '{_d(c)} 00:00:00' THEN {k}" for k, c in enumerate(cutoffs)) + f" ELSE {len(cutoffs)} END"
    parts = []
    for k in range(1, len(cutoffs)):
        base = ORACLE_CTES.replace("m_orders AS", "every_order AS")
        parts.append(f"""(WITH {base},
m_orders AS (SELECT * FROM every_order WHERE least({due} + CAST(order_id % 17 = 0 AS INT), {len(cutoffs) - 1}) <= {k}),
{feature_ctes(cutoffs[k], base=False).strip()}
SELECT DATE '{_d(cutoffs[k])}' AS cutoff_date, * FROM features)""")
    return "\nUNION ALL\n".join(parts)


# ------------------------------------------------------------ transform / dq

def transformed_cte(cutoff, sfx: str = "", base: bool = True) -> str:
    return feature_ctes(cutoff, sfx=sfx, base=base) + "," + _suffix(f"""
transformed AS (
    SELECT customer_id, signup_date, country,
           CAST(COALESCE(CAST(order_count AS DOUBLE), 0) AS BIGINT) AS order_count,
           last_order_date,
           COALESCE(total_spend, 0.0) AS total_spend,
           CAST(COALESCE(CAST(distinct_products AS DOUBLE), 0) AS BIGINT) AS distinct_products,
           CAST(LEAST(COALESCE(CAST(recency_days AS DOUBLE), 9999), 730) AS BIGINT) AS recency_days,
           CAST(COALESCE(CAST(tenure_days AS DOUBLE), 0) AS BIGINT) AS tenure_days,
           orders_next_90d,
           CAST(COALESCE(CAST(churned AS DOUBLE), 0) AS INTEGER) AS churned
      FROM features
)""", sfx)


def transform_features(cutoff) -> str:
    return f"WITH {transformed_cte(cutoff)} SELECT * FROM transformed"


def training_rows(cutoff) -> str:
    return f"""WITH {feature_ctes(cutoff)}
SELECT customer_id, order_count, total_spend, distinct_products,
       CASE WHEN recency_days IS NULL THEN NULL ELSE LEAST(recency_days, 730) END AS recency_days,
       tenure_days, churned
  FROM features
 WHERE order_count IS NOT NULL AND total_spend IS NOT NULL AND NOT isnan(total_spend)
   AND distinct_products IS NOT NULL AND recency_days IS NOT NULL
   AND tenure_days IS NOT NULL AND churned IS NOT NULL"""


def validate_report_sql(ctes: str, rel: str, max_null=0.01) -> str:
    cols = ["customer_id", "order_count", "total_spend", "distinct_products", "recency_days",
            "tenure_days", "churned"]
    nulls = ", ".join(f"COUNT(*) FILTER (WHERE {c} IS NULL"
                      + (f" OR isnan({c})" if c == "total_spend" else "") + ")" for c in cols)
    return f"""WITH {ctes},
s AS (
    SELECT COUNT(*) AS n_rows,
           COUNT(*) FILTER (WHERE NOT COALESCE(order_count >= 0, false)) AS bad_oc,
           COUNT(*) FILTER (WHERE NOT COALESCE(total_spend >= 0 AND NOT isnan(total_spend), false)) AS bad_ts,
           COUNT(*) FILTER (WHERE NOT COALESCE(churned IN (0, 1), false)) AS bad_ch,
           GREATEST({nulls}, 0) AS worst_null
      FROM {rel}
),
d AS (
    SELECT COALESCE(SUM(n - 1), 0) AS dup_rows
      FROM (SELECT customer_id, COUNT(*) AS n FROM {rel} GROUP BY customer_id) g WHERE n > 1
)
SELECT 'required_columns' AS "check", true AS passed, CAST(0 AS BIGINT) AS n_bad, 0.0::DOUBLE AS value,
       'all required columns present' AS rule
UNION ALL SELECT 'key_unique', dup_rows = 0, CAST(dup_rows AS BIGINT), CAST(dup_rows AS DOUBLE), 'customer_id unique' FROM d
UNION ALL SELECT 'order_count_nonneg', bad_oc = 0, bad_oc, CAST(bad_oc AS DOUBLE), 'order_count >= 0' FROM s
UNION ALL SELECT 'total_spend_nonneg', bad_ts = 0, bad_ts, CAST(bad_ts AS DOUBLE), 'total_spend >= 0' FROM s
UNION ALL SELECT 'churned_binary', bad_ch = 0, bad_ch, CAST(bad_ch AS DOUBLE), 'churned in (0, 1)' FROM s
UNION ALL SELECT 'non_empty', n_rows > 0, CASE WHEN n_rows = 0 THEN 1 ELSE 0 END, CAST(n_rows AS DOUBLE), 'at least one row' FROM s
UNION ALL SELECT 'null_fraction',
       (CASE WHEN n_rows > 0 THEN worst_null / n_rows ELSE 0.0 END) < {max_null},
       CAST(worst_null AS BIGINT),
       CASE WHEN n_rows > 0 THEN worst_null / n_rows ELSE 0.0 END,
       'max NULL fraction over required columns < {max_null}' FROM s"""


def validate_report(cutoff) -> str:
    return validate_report_sql(transformed_cte(cutoff), "transformed")


def validate_report_backtest(cutoffs) -> str:
    return validate_report_sql(f"bt AS ({multi_cutoff(cutoffs)})", "bt")


def label_rate(cutoff) -> str:
    return (f"WITH {feature_ctes(cutoff)} SELECT COUNT(*) AS n_rows, "
            "ROUND(AVG(churned), 9) AS churn_rate FROM features")


def dq_null_rates() -> str:
    def part(rel, name, cols):
        return "\nUNION ALL\n".join(
            f"SELECT '{name}' AS table_name, '{c}' AS column_name, COUNT(*) AS n_rows, "
            f"COUNT(*) FILTER (WHERE {c} IS NULL) AS n_null, "
            f"CASE WHEN COUNT(*) > 0 THEN COUNT(*) FILTER (WHERE {c} IS NULL) / COUNT(*) ELSE 0.0 END AS null_rate "
            f"FROM {rel}" for c in cols)
    return f"""WITH {ORACLE_CTES}
{part('m_customers', 'customers', ['customer_id', 'signup_date', 'country'])}
UNION ALL
{part('m_orders', 'orders', ['order_id', 'customer_id', 'order_date', 'status', 'order_total'])}
UNION ALL
{part('m_items', 'order_items', ['order_item_id', 'order_id', 'product_id', 'quantity'])}
UNION ALL
{part('m_products', 'products', ['product_id', 'product_name', 'category', 'unit_price'])}"""


def dq_duplicates() -> str:
    return f"""WITH {ORACLE_CTES}
SELECT order_id, product_id, COUNT(*) AS n_rows FROM m_items
 GROUP BY order_id, product_id HAVING COUNT(*) > 1"""


def dedup_order_items() -> str:
    return f"""WITH {ORACLE_CTES}
SELECT order_item_id, order_id, product_id, quantity FROM (
  SELECT *, row_number() OVER (PARTITION BY order_id, product_id ORDER BY order_item_id, quantity) AS rn
    FROM m_items) t WHERE rn = 1"""


def dq_fk_orphans() -> str:
    def part(rel, child, fk, parent, pk):
        return (f"SELECT '{rel}' AS relation, COUNT(*) AS n_checked, "
                f"COUNT(*) FILTER (WHERE NOT EXISTS (SELECT 1 FROM {parent} p WHERE p.{pk} = c.{fk})) AS n_orphans "
                f"FROM {child} c WHERE c.{fk} IS NOT NULL")
    return f"""WITH {ORACLE_CTES}
{part('orders.customer_id -> customers', 'm_orders', 'customer_id', 'm_customers', 'customer_id')}
UNION ALL
{part('order_items.order_id -> orders', 'm_items', 'order_id', 'm_orders', 'order_id')}
UNION ALL
{part('order_items.product_id -> products', 'm_items', 'product_id', 'm_products', 'product_id')}"""


def item_price_lookup() -> str:
    return f"""WITH {ORACLE_CTES}
SELECT i.order_item_id, i.order_id, i.product_id, i.quantity, CAST(p.unit_price AS DOUBLE) AS unit_price
  FROM m_items i LEFT JOIN m_products p ON p.product_id = i.product_id"""


def order_total_rollup() -> str:
    return f"""WITH {ORACLE_CTES},
lines AS (
    SELECT i.order_id, SUM(i.quantity * p.unit_price) AS items_total
      FROM m_items i LEFT JOIN m_products p ON p.product_id = i.product_id
     GROUP BY i.order_id
)
SELECT o.order_id, CAST(o.order_total AS DOUBLE) AS order_total,
       CAST(ROUND(COALESCE(l.items_total, 0), 2) AS DOUBLE) AS rollup_total,
       CAST(o.order_total AS DOUBLE) = CAST(ROUND(COALESCE(l.items_total, 0), 2) AS DOUBLE) AS matches
  FROM m_orders o LEFT JOIN lines l ON l.order_id = o.order_id"""


# ------------------------------------------------------------------- drift

FEATURES = ["order_count", "total_spend", "distinct_products", "recency_days", "tenure_days"]


def _probs(buckets=10):
    step = 1.0 / buckets
    return "[" + ", ".join(repr(i * step) for i in range(buckets)) + ", 1.0]"


def _long(rel, feats):
    return " UNION ALL ".join(
        f"SELECT '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM {rel}" for f in feats)


def _bin_case(edges="edges", v="value"):
    return (f"CASE WHEN len({edges}) < 2 THEN NULL "
            f"WHEN {v} < {edges}[1] OR {v} > {edges}[len({edges})] THEN NULL "
            f"WHEN {v} = {edges}[len({edges})] THEN len({edges}) - 2 "
            f"ELSE len(list_filter({edges}, lambda x: x <= {v})) - 1 END")


def _drift_ctes(c_expected, c_actual, digits=6, buckets=10) -> str:
    return f"""WITH {transformed_cte(c_expected, '_e')}, {transformed_cte(c_actual, '_a', base=False)},
le AS ({_long('transformed_e', FEATURES)}),
la AS ({_long('transformed_a', FEATURES)}),
edges AS (
    SELECT feature,
           list_sort(list_distinct(list_transform(quantile_cont(value, {_probs(buckets)}),
                                                  lambda x: round(x, {digits})))) AS edges
      FROM le WHERE value IS NOT NULL AND NOT isnan(value) GROUP BY feature
),
binned AS (
    SELECT l.side, l.feature, {_bin_case()} AS bin
      FROM (SELECT 'expected' AS side, * FROM le UNION ALL SELECT 'actual' AS side, * FROM la) l
      JOIN edges USING (feature)
     WHERE l.value IS NOT NULL AND NOT isnan(l.value)
),
skel AS (
    SELECT e.feature, s.side, b.bin, e.edges[b.bin + 1] AS lower, e.edges[b.bin + 2] AS upper
      FROM edges e CROSS JOIN (VALUES ('expected'), ('actual')) s(side)
      CROSS JOIN LATERAL (SELECT unnest(range(0, CAST(greatest(len(e.edges) - 1, 0) AS BIGINT))) AS bin) b
),
hist AS (
    SELECT k.feature, k.side, CAST(k.bin AS BIGINT) AS bin, k.lower, k.upper,
           COALESCE(c.n, 0) AS n
      FROM skel k LEFT JOIN (SELECT feature, side, bin, COUNT(*) AS n FROM binned
                              WHERE bin IS NOT NULL GROUP BY ALL) c
        ON c.feature = k.feature AND c.side = k.side AND c.bin = k.bin
),
tot AS (
    SELECT feature,
           COUNT(*) FILTER (WHERE side = 'expected') AS n_expected,
           COUNT(*) FILTER (WHERE side = 'actual') AS n_actual,
           COUNT(*) FILTER (WHERE side = 'actual' AND bin IS NULL) AS n_out_of_range
      FROM binned GROUP BY feature
),
fr AS (
    SELECT h.feature,
           GREATEST(SUM(h.n) FILTER (WHERE h.side = 'expected') / t.n_expected, 1e-4) AS pe,
           GREATEST(SUM(h.n) FILTER (WHERE h.side = 'actual') / GREATEST(t.n_actual, 1), 1e-4) AS pa
      FROM hist h JOIN tot t USING (feature)
     GROUP BY h.feature, h.bin, t.n_expected, t.n_actual
)"""


def _verdict(x):
    return (f"CASE WHEN {x} IS NULL THEN 'NO_DATA' WHEN {x} < 0.1 THEN 'OK' "
            f"WHEN {x} < 0.25 THEN 'INVESTIGATE' ELSE 'RETRAIN' END")


def psi_edges(c_expected, c_actual) -> str:
    return (_drift_ctes(c_expected, c_actual)
            + " SELECT feature, CAST(generate_subscripts(edges, 1) - 1 AS BIGINT) AS edge_idx, "
              "unnest(edges) AS edge FROM edges")


def psi_histogram(c_expected, c_actual) -> str:
    return _drift_ctes(c_expected, c_actual) + " SELECT * FROM hist"


def psi_report(c_expected, c_actual) -> str:
    return _drift_ctes(c_expected, c_actual) + f"""
SELECT t.feature, ROUND(COALESCE(p.psi, 0.0), 9) AS psi, {_verdict('ROUND(COALESCE(p.psi, 0.0), 9)')} AS verdict,
       t.n_expected, t.n_actual, t.n_out_of_range,
       CAST(greatest(len(e.edges) - 1, 0) AS BIGINT) AS n_bins
  FROM tot t JOIN edges e USING (feature)
  LEFT JOIN (SELECT feature, SUM((pa - pe) * ln(pa / pe)) AS psi FROM fr GROUP BY feature) p
    USING (feature)"""


def psi_report_common_features(c_expected, c_actual) -> str:
    return f"SELECT * FROM ({psi_report(c_expected, c_actual)}) WHERE feature NOT IN ('tenure_days', 'total_spend')"


def windowed_psi(digits=6, buckets=10) -> str:
    """Per (day, event_type) PSI of events.value against the whole table."""
    return f"""WITH ev AS (
    SELECT event_type, date_trunc('day', ts) AS window_start, value FROM events
     WHERE value IS NOT NULL AND NOT isnan(value)
),
edges AS (
    SELECT event_type,
           list_sort(list_distinct(list_transform(quantile_cont(value, {_probs(buckets)}),
                                                  lambda x: round(x, {digits})))) AS edges,
           COUNT(*) AS n_expected
      FROM ev GROUP BY event_type
),
binned AS (
    SELECT ev.event_type, ev.window_start, {_bin_case('e.edges', 'ev.value')} AS bin
      FROM ev JOIN edges e USING (event_type)
),
ecount AS (SELECT event_type, bin, COUNT(*) AS n FROM binned WHERE bin IS NOT NULL GROUP BY ALL),
acount AS (SELECT event_type, window_start, bin, COUNT(*) AS n FROM binned WHERE bin IS NOT NULL GROUP BY ALL),
wins AS (
    SELECT event_type, window_start, COUNT(*) AS n_actual,
           COUNT(*) FILTER (WHERE bin IS NULL) AS n_out_of_range
      FROM binned GROUP BY ALL
),
skel AS (
    SELECT w.event_type, w.window_start, w.n_actual, w.n_out_of_range, e.n_expected, b.bin
      FROM wins w JOIN edges e USING (event_type)
      CROSS JOIN LATERAL (SELECT unnest(range(0, CAST(greatest(len(e.edges) - 1, 0) AS BIGINT))) AS bin) b
),
terms AS (
    SELECT s.event_type, s.window_start, s.n_actual, s.n_out_of_range,
           GREATEST(COALESCE(ec.n, 0) / s.n_expected, 1e-4) AS pe,
           GREATEST(COALESCE(ac.n, 0) / GREATEST(s.n_actual, 1), 1e-4) AS pa
      FROM skel s
      LEFT JOIN ecount ec ON ec.event_type = s.event_type AND ec.bin = s.bin
      LEFT JOIN acount ac ON ac.event_type = s.event_type AND ac.window_start = s.window_start
                         AND ac.bin = s.bin
)
SELECT event_type, window_start, n_actual, n_out_of_range,
       ROUND(SUM((pa - pe) * ln(pa / pe)), 9) AS psi,
       {_verdict('ROUND(SUM((pa - pe) * ln(pa / pe)), 9)')} AS verdict
  FROM terms GROUP BY event_type, window_start, n_actual, n_out_of_range"""


def sliding_psi(days=7, digits=6, buckets=10) -> str:
    """Per (seven days from each day on, event_type) PSI of events.value
    against the whole table; a window joins its rows by the time itself."""
    return f"""WITH ev AS (SELECT event_type, ts, value FROM events WHERE value IS NOT NULL AND NOT isnan(value)),
edges AS (
    SELECT event_type, COUNT(*) AS n_expected,
           list_sort(list_distinct(list_transform(quantile_cont(value, {_probs(buckets)}), lambda x: round(x, {digits})))) AS edges
      FROM ev GROUP BY event_type
),
days AS (SELECT DISTINCT event_type, date_trunc('day', ts) AS day FROM ev),
wins AS (
    SELECT DISTINCT event_type, w AS window_start, w + INTERVAL {days} DAY AS window_end
      FROM (SELECT event_type, unnest(generate_series(day - INTERVAL {days - 1} DAY, day, INTERVAL 1 DAY)) AS w FROM days)
),
bounds AS (SELECT event_type, n_expected, edges, CAST(unnest(range(0, len(edges) - 1)) AS BIGINT) AS bin FROM edges),
inside AS (
    SELECT b.event_type, b.bin, b.n_expected, e.ts
      FROM bounds b JOIN ev e ON e.event_type = b.event_type AND e.value >= b.edges[b.bin + 1]
       AND (e.value < b.edges[b.bin + 2] OR (b.bin = len(b.edges) - 2 AND e.value = b.edges[b.bin + 2]))
),
expected AS (SELECT event_type, bin, COUNT(*) AS n FROM inside GROUP BY ALL),
hist AS (SELECT w.event_type, w.window_start, i.bin, COUNT(*) AS n
           FROM wins w JOIN inside i ON i.event_type = w.event_type AND i.ts >= w.window_start AND i.ts < w.window_end GROUP BY ALL),
live AS (SELECT w.event_type, w.window_start, w.window_end, COUNT(*) AS n_actual
           FROM wins w JOIN ev e ON e.event_type = w.event_type AND e.ts >= w.window_start AND e.ts < w.window_end GROUP BY ALL),
terms AS (
    SELECT l.*, ifnull(h.n, 0) AS n, GREATEST(ifnull(x.n, 0) / b.n_expected, 1e-4) AS pe,
           GREATEST(ifnull(h.n, 0) / l.n_actual, 1e-4) AS pa
      FROM live l JOIN bounds b USING (event_type) LEFT JOIN expected x ON x.event_type = b.event_type AND x.bin = b.bin
      LEFT JOIN hist h ON h.event_type = l.event_type AND h.window_start = l.window_start AND h.bin = b.bin
)
SELECT event_type, window_start, window_end, n_actual, CAST(n_actual - SUM(n) AS BIGINT) AS n_out_of_range,
       ROUND(SUM((pa - pe) * ln(pa / pe)), 9) AS psi, {_verdict('ROUND(SUM((pa - pe) * ln(pa / pe)), 9)')} AS verdict
  FROM terms GROUP BY event_type, window_start, window_end, n_actual"""


def grouped_psi_unseen(digits=6, buckets=10) -> str:
    """PSI per integer group; NULL is a group and some live ones are not expected."""
    same = "IS NOT DISTINCT FROM"
    psi = "ROUND(SUM((pa - pe) * ln(pa / pe)), 9)"
    return f"""WITH old AS (
    SELECT CASE WHEN user_id % 13 < 8 THEN CAST(user_id % 13 AS INTEGER) END AS grp, value FROM events
     WHERE value IS NOT NULL AND NOT isnan(value)
),
live AS (
    SELECT CASE WHEN user_id % 17 < 12 THEN CAST(user_id % 17 AS INTEGER) END AS grp, value FROM events
     WHERE value IS NOT NULL AND NOT isnan(value)
),
edges AS (
    SELECT grp, COUNT(*) AS n_expected,
           list_sort(list_distinct(list_transform(quantile_cont(value, {_probs(buckets)}),
                                                  lambda x: round(x, {digits})))) AS edges
      FROM old GROUP BY grp
),
seen AS (SELECT o.grp, {_bin_case('e.edges', 'o.value')} AS bin FROM old o JOIN edges e ON o.grp {same} e.grp),
met AS (SELECT l.grp, {_bin_case('e.edges', 'l.value')} AS bin FROM live l LEFT JOIN edges e ON l.grp {same} e.grp),
tot AS (SELECT grp, COUNT(*) AS n_actual, COUNT(*) FILTER (WHERE bin IS NULL) AS n_out_of_range FROM met GROUP BY grp),
bins AS (SELECT grp, n_expected, unnest(range(0, len(edges) - 1)) AS bin FROM edges),
terms AS (
    SELECT b.grp, GREATEST((SELECT COUNT(*) FROM seen s WHERE s.grp {same} b.grp AND s.bin = b.bin) / b.n_expected, 1e-4) AS pe,
           GREATEST((SELECT COUNT(*) FROM met m WHERE m.grp {same} b.grp AND m.bin = b.bin)
                    / GREATEST((SELECT SUM(n_actual) FROM tot t WHERE t.grp {same} b.grp), 1), 1e-4) AS pa
      FROM bins b
),
psi AS (SELECT grp, {psi} AS psi FROM terms GROUP BY grp)
SELECT t.grp, t.n_actual, t.n_out_of_range, p.psi, {_verdict('p.psi')} AS verdict
  FROM tot t LEFT JOIN psi p ON t.grp {same} p.grp"""


def approx_distinct_products(cutoffs) -> str:
    """Exact distinct products by country and cutoff; estimates must be near."""
    dates = ", ".join(f"DATE '{_d(c)}'" for c in cutoffs)
    return f"""WITH {ORACLE_CTES}
SELECT c AS cutoff_date, country, COUNT(DISTINCT product_id) AS exact, TRUE AS within_bound
  FROM m_orders JOIN m_customers USING (customer_id) JOIN m_items USING (order_id), (SELECT unnest([{dates}]) AS c)
 WHERE order_date <= c GROUP BY ALL HAVING COUNT(DISTINCT product_id) > 0"""


def approx_customer_products(cutoffs) -> str:
    dates = ", ".join(f"DATE '{_d(c)}'" for c in cutoffs)
    return f"""WITH {ORACLE_CTES}
SELECT c AS cutoff_date, customer_id, COUNT(DISTINCT product_id) AS distinct_products
  FROM m_orders JOIN m_items USING (order_id), (SELECT unnest([{dates}]) AS c)
 WHERE order_date <= c GROUP BY ALL HAVING COUNT(DISTINCT product_id) > 0"""


def form_equivalence() -> str:
    return "SELECT unnest(['grouped', 'sql']) AS form, CAST(0 AS BIGINT) AS differing, (SELECT COUNT(*) FROM customer) AS n_rows"


def form_difference(cutoff) -> str:
    """What EXCEPT ALL finds either way."""
    cols = "customer_id, total_spend"
    return f"""WITH {feature_ctes(cutoff)},
planted AS (
    SELECT * REPLACE (CASE WHEN customer_id % 157 = 5 THEN total_spend + CAST(0.01 AS DOUBLE) ELSE total_spend END AS total_spend)
      FROM features, (SELECT unnest([1, 2]) AS copy) WHERE customer_id % 211 <> 3 AND (copy = 1 OR customer_id % 307 = 9)
),
gone AS (SELECT * FROM features EXCEPT ALL SELECT * EXCLUDE (copy) FROM planted),
came AS (SELECT * EXCLUDE (copy) FROM planted EXCEPT ALL SELECT * FROM features),
counts AS (
    SELECT {cols}, SUM(l) AS l, SUM(r) AS r FROM (SELECT {cols}, 1 AS l, 0 AS r FROM features UNION ALL SELECT {cols}, 0, 1 FROM planted) GROUP BY ALL
)
SELECT DISTINCT {cols}, CAST(l AS BIGINT) AS n_left, CAST(r AS BIGINT) AS n_right
  FROM counts JOIN (SELECT {cols} FROM gone UNION SELECT {cols} FROM came) USING ({cols})"""


def sketched_profile(first, last, buckets=10) -> str:
    return f"""SELECT event_type, COUNT(*) AS n, q_idx, TRUE AS within_bound
  FROM events, (SELECT unnest(range(0, {buckets + 1})) AS q_idx)
 WHERE value IS NOT NULL AND NOT isnan(value) AND CAST(ts AS DATE) BETWEEN DATE '{_d(first)}' AND DATE '{_d(last)}'
 GROUP BY event_type, q_idx"""


def sketched_psi(first, last) -> str:
    return f"""SELECT event_type, COUNT(*) AS n_actual, TRUE AS within_bound FROM events
 WHERE value IS NOT NULL AND NOT isnan(value) AND CAST(ts AS DATE) > DATE '{_d(last)}' GROUP BY event_type"""


# ------------------------------------------------------ split and metrics

def _training_rows_cte(cutoff) -> str:
    return f"""{feature_ctes(cutoff)},
tr AS (
    SELECT customer_id, order_count, total_spend, distinct_products,
           LEAST(recency_days, 730) AS recency_days, tenure_days, churned
      FROM features
     WHERE order_count IS NOT NULL AND total_spend IS NOT NULL AND distinct_products IS NOT NULL
       AND recency_days IS NOT NULL AND tenure_days IS NOT NULL AND churned IS NOT NULL
)"""


def stratified_split(cutoff, test_fraction=0.2, seed=42) -> str:
    return f"""WITH {_training_rows_cte(cutoff)},
cc AS (SELECT churned, COUNT(*) AS c FROM tr GROUP BY churned),
tot AS (SELECT SUM(c) AS n, CAST(ceil(CAST({test_fraction} AS DOUBLE) * SUM(c)) AS BIGINT) AS n_test FROM cc),
fl AS (
    SELECT cc.churned, cc.c, tot.n - tot.n_test AS n_train,
           floor(cc.c / tot.n * (tot.n - tot.n_test)) AS fl,
           cc.c / tot.n * (tot.n - tot.n_test) - floor(cc.c / tot.n * (tot.n - tot.n_test)) AS rem
      FROM cc, tot
),
need AS (SELECT MAX(n_train) - SUM(fl) AS need FROM fl),
tk AS (
    SELECT churned,
           c - (fl + CASE WHEN row_number() OVER (ORDER BY rem DESC, churned) <= (SELECT need FROM need)
                          THEN 1 ELSE 0 END) AS test_k
      FROM fl
),
rk AS (
    SELECT customer_id, churned,
           row_number() OVER (PARTITION BY churned
                              ORDER BY md5(concat('{seed}:', CAST(customer_id AS VARCHAR))), customer_id) AS rn
      FROM tr
)
SELECT customer_id, churned, rn <= test_k AS is_test FROM rk JOIN tk USING (churned)"""


SCORE_SQL = ("CAST(0.7 AS DOUBLE) * (CAST(recency_days AS DOUBLE) / CAST(730.0 AS DOUBLE)) "
             "+ CAST(0.3 AS DOUBLE) / CAST(1 + order_count AS DOUBLE)")


def _scored_cte(cutoff) -> str:
    return f"""{transformed_cte(cutoff)},
scored AS (SELECT customer_id, churned, {SCORE_SQL} AS score FROM transformed),
sc AS (SELECT score, COUNT(*) FILTER (WHERE churned = 1) AS pos,
              COUNT(*) FILTER (WHERE churned <> 1) AS neg FROM scored GROUP BY score)"""


def classification_metrics(cutoff) -> str:
    return f"""WITH {_scored_cte(cutoff)},
c AS (
    SELECT COUNT(*) FILTER (WHERE churned = 1 AND score >= 0.5) AS tp,
           COUNT(*) FILTER (WHERE churned <> 1 AND score >= 0.5) AS fp,
           COUNT(*) FILTER (WHERE churned <> 1 AND NOT score >= 0.5) AS tn,
           COUNT(*) FILTER (WHERE churned = 1 AND NOT score >= 0.5) AS fn
      FROM scored
)
SELECT ROUND(CASE WHEN tp + fp + tn + fn = 0 THEN 0.0 ELSE (tp + tn) / (tp + fp + tn + fn) END, 9) AS accuracy,
       ROUND(CASE WHEN tp + fp = 0 THEN 0.0 ELSE tp / (tp + fp) END, 9) AS precision,
       ROUND(CASE WHEN tp + fn = 0 THEN 0.0 ELSE tp / (tp + fn) END, 9) AS recall,
       ROUND(CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE 2 * tp / (2 * tp + fp + fn) END, 9) AS f1,
       tp, fp, tn, fn
  FROM c"""


def roc_auc(cutoff) -> str:
    return f"""WITH {_scored_cte(cutoff)},
r AS (SELECT pos, neg, COALESCE(SUM(neg) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING
                                                AND 1 PRECEDING), 0) AS neg_before FROM sc)
SELECT ROUND(SUM(CAST(pos AS DOUBLE) * (CAST(neg_before AS DOUBLE) + CAST(neg AS DOUBLE) * 0.5::DOUBLE))
             / (CAST(SUM(pos) AS DOUBLE) * SUM(neg)), 9) AS auc,
       CAST(SUM(pos) AS BIGINT) AS n_pos, CAST(SUM(neg) AS BIGINT) AS n_neg
  FROM r"""


def roc_curve(cutoff) -> str:
    return f"""WITH {_scored_cte(cutoff)},
tot AS (SELECT SUM(pos) AS p, SUM(neg) AS n FROM sc),
pts AS (SELECT score AS threshold, SUM(pos) OVER (ORDER BY score DESC) AS tp,
               SUM(neg) OVER (ORDER BY score DESC) AS fp FROM sc)
SELECT threshold, CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp,
       ROUND(CASE WHEN p = 0 THEN 0.0 ELSE tp / p END, 9) AS tpr,
       ROUND(CASE WHEN n = 0 THEN 0.0 ELSE fp / n END, 9) AS fpr
  FROM pts, tot
UNION ALL SELECT CAST(NULL AS DOUBLE), 0, 0, 0.0, 0.0"""


def scaler_stats(cutoff) -> str:
    parts = " UNION ALL ".join(
        f"SELECT '{f}' AS feature, COUNT({f}) AS n, ROUND(AVG(CAST({f} AS DOUBLE)), 6) AS mean, "
        f"ROUND(STDDEV_POP(CAST({f} AS DOUBLE)), 6) AS std_pop, "
        f"ROUND(STDDEV_SAMP(CAST({f} AS DOUBLE)), 6) AS std_sample FROM tr" for f in FEATURES)
    return f"WITH {_training_rows_cte(cutoff)} {parts}"


# ----------------------------------------------------------------- scoring

REQ_FIELDS = ["order_count", "total_spend", "distinct_products", "recency_days", "tenure_days"]
REQ_DEFAULTS = {"order_count": "0", "total_spend": "0.0", "distinct_products": "0",
                "recency_days": "9999", "tenure_days": "0"}


def _requests_cte(cutoff) -> str:
    return f"""{feature_ctes(cutoff)},
req AS (
    SELECT customer_id, nullif(order_count, 0) AS order_count,
           CASE WHEN order_count > 0 THEN total_spend END AS total_spend,
           nullif(distinct_products, 0) AS distinct_products,
           CASE WHEN order_count > 0 THEN recency_days END AS recency_days, tenure_days
    FROM features
)"""


def _ok(f):
    extra = f" AND NOT isnan({f})" if f == "total_spend" else ""
    return f"({f} IS NULL OR ({f} >= 0{extra}))"


def score_inputs(cutoff) -> str:
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    used = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in REQ_FIELDS)
    filled = ", ".join(f"COALESCE({f}, {REQ_DEFAULTS[f]}) AS {f}" for f in REQ_FIELDS)
    return f"""WITH {_requests_cte(cutoff)}
SELECT customer_id, {filled}, concat_ws(',', {used}) AS used_defaults
  FROM req WHERE {ok}"""


def score_rejects(cutoff) -> str:
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    why = ", ".join(f"CASE WHEN NOT {_ok(f)} THEN '{f}' END" for f in REQ_FIELDS)
    return f"""WITH {_requests_cte(cutoff)}
SELECT customer_id, {', '.join(REQ_FIELDS)}, concat_ws(',', {why}) AS reject_reason
  FROM req WHERE NOT ({ok})"""


def published_dataset(cutoff) -> str:
    return f"WITH {transformed_cte(cutoff)} SELECT *, DATE '{_d(cutoff)}' AS cutoff_date FROM transformed"


def log_drift_report(c_expected, c_actual, digits=6, buckets=10) -> str:
    """PSI of logged (post-default) request inputs at c_actual against the
    published dataset at c_expected."""
    filled = ", ".join(f"COALESCE({f}, {REQ_DEFAULTS[f]}) AS {f}" for f in REQ_FIELDS)
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    ctes = _drift_ctes(c_expected, c_expected, digits, buckets)
    # replace the actual side by the accepted, default-filled requests
    req = _requests_cte(c_actual).replace(ORACLE_CTES + ",", "", 1)
    req = _suffix(req, "_r")
    ctes = ctes.replace("la AS (", f"""{req},
logged AS (SELECT {filled} FROM req WHERE {ok}),
la AS (""", 1)
    ctes = ctes.replace(f"la AS ({_long('transformed_a', FEATURES)})", f"la AS ({_long('logged', FEATURES)})")
    return ctes + f"""
SELECT t.feature, ROUND(COALESCE(p.psi, 0.0), 9) AS psi, {_verdict('ROUND(COALESCE(p.psi, 0.0), 9)')} AS verdict,
       t.n_expected, t.n_actual, t.n_out_of_range,
       CAST(greatest(len(e.edges) - 1, 0) AS BIGINT) AS n_bins
  FROM tot t JOIN edges e USING (feature)
  LEFT JOIN (SELECT feature, SUM((pa - pe) * ln(pa / pe)) AS psi FROM fr GROUP BY feature) p
    USING (feature)"""


def published_backtest(cutoffs) -> str:
    return "\nUNION ALL\n".join(f"({published_dataset(c)})" for c in cutoffs)


# The score of batch_scores_formula.
FORMULA = "((recency_days * 7 + order_count) % 1300) / 900.0 - 0.1"


def batch_scores_formula(cutoff) -> str:
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    used = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in REQ_FIELDS)
    filled = ", ".join(f"COALESCE({f}, {REQ_DEFAULTS[f]}) AS {f}" for f in REQ_FIELDS)
    return f"""WITH {_requests_cte(cutoff)},
filled AS (SELECT customer_id, {filled}, concat_ws(',', {used}) AS used_defaults FROM req WHERE {ok}),
scored AS (SELECT *, greatest(0.0, least(1.0, CAST({FORMULA} AS DOUBLE))) AS s FROM filled)
SELECT customer_id, {', '.join(REQ_FIELDS)}, CAST(round_even(s, 4) AS DOUBLE) AS churn_probability,
       CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, 'formula' AS model_source, used_defaults FROM scored"""


def log_windowed_psi(c_expected, c_actual, digits=6, buckets=10) -> str:
    """Per (7 days, feature): accepted requests of c_actual, logged at times
    that follow the key, against the features of c_expected."""
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    filled = ", ".join(f"COALESCE({f}, {REQ_DEFAULTS[f]}) AS {f}" for f in REQ_FIELDS)
    req = _suffix(_requests_cte(c_actual).replace(ORACLE_CTES + ",", "", 1), "_r")
    week = "time_bucket(INTERVAL 7 DAY, TIMESTAMP '2024-01-01' + to_days(CAST(customer_id // 150 AS INTEGER)), TIMESTAMP '1970-01-01')"
    live = " UNION ALL ".join(f"SELECT window_start, '{f}' AS feature, CAST({f} AS DOUBLE) AS value FROM logged" for f in FEATURES)
    psi = "ROUND(SUM((pa - pe) * ln(pa / pe)), 9)"
    return f"""WITH {transformed_cte(c_expected, '_e')}, {req},
logged AS (SELECT {week} AS window_start, {filled} FROM req WHERE {ok}),
old AS ({_long('transformed_e', FEATURES)}),
live AS ({live}),
edges AS (
    SELECT feature, COUNT(*) AS n_expected,
           list_sort(list_distinct(list_transform(quantile_cont(value, {_probs(buckets)}),
                                                  lambda x: round(x, {digits})))) AS edges FROM old GROUP BY feature
),
seen AS (SELECT feature, bin, COUNT(*) AS n FROM (SELECT o.feature, {_bin_case('e.edges', 'o.value')} AS bin
         FROM old o JOIN edges e USING (feature)) GROUP BY ALL),
binned AS (SELECT l.window_start, l.feature, {_bin_case('e.edges', 'l.value')} AS bin FROM live l JOIN edges e USING (feature)),
met AS (SELECT window_start, feature, bin, COUNT(*) AS n FROM binned GROUP BY ALL),
tot AS (SELECT window_start, feature, COUNT(*) AS n_actual, COUNT(*) FILTER (WHERE bin IS NULL) AS n_out_of_range
        FROM binned GROUP BY ALL),
bins AS (SELECT feature, n_expected, unnest(range(0, len(edges) - 1)) AS bin FROM edges),
terms AS (
    SELECT t.window_start, t.feature, t.n_actual, t.n_out_of_range, GREATEST(COALESCE(s.n, 0) / b.n_expected, 1e-4) AS pe,
           GREATEST(COALESCE(m.n, 0) / t.n_actual, 1e-4) AS pa
      FROM tot t JOIN bins b USING (feature)
      LEFT JOIN seen s ON s.feature = b.feature AND s.bin = b.bin
      LEFT JOIN met m ON m.feature = b.feature AND m.bin = b.bin AND m.window_start = t.window_start
)
SELECT feature, window_start, n_actual, n_out_of_range, {psi} AS psi, {_verdict(psi)} AS verdict
  FROM terms GROUP BY feature, window_start, n_actual, n_out_of_range"""


# ------------------------------------------------------------ dirty inputs

# The request fields of dirty_score_rejects and the keys that spoil them.
BAD_FIELDS = {"order_count": 31, "total_spend": 43, "distinct_products": 37, "recency_days": 41, "tenure_days": 47}


def dirty(sql: str) -> str:
    """A twin over the dirty tables."""
    return sql.replace(ORACLE_CTES, DIRTY_CTES)


def dirty_validate_report(cutoff) -> str:
    return dirty(validate_report_sql(feature_ctes(cutoff) + """,
spoiled AS (
    SELECT customer_id, CASE WHEN customer_id % 61 = 0 THEN -1 ELSE order_count END AS order_count, total_spend,
           distinct_products, recency_days, tenure_days, CASE WHEN customer_id % 83 = 0 THEN 2 ELSE churned END AS churned
      FROM features
)""", "spoiled"))


def dirty_fractional_transform(cutoff) -> str:
    return dirty(f"""WITH {feature_ctes(cutoff)}
SELECT customer_id, CAST(trunc(CASE WHEN customer_id % 9 = 4 THEN -order_count - CAST(0.75 AS DOUBLE) ELSE order_count + CAST(0.75 AS DOUBLE) END) AS BIGINT) AS order_count,
       CAST(trunc(distinct_products * CAST(1.3 AS DOUBLE)) AS BIGINT) AS distinct_products,
       CAST(trunc(least(recency_days + CAST(0.9 AS DOUBLE), 730)) AS BIGINT) AS recency_days,
       CAST(trunc(ifnull(tenure_days / CAST(7 AS DOUBLE), 0)) AS BIGINT) AS tenure_days FROM features""")


def dirty_fractional_rollup() -> str:
    """Whole tenths of cents; a tie goes to the even cent."""
    return dirty(f"""WITH {ORACLE_CTES},
tenths AS (SELECT order_id, SUM(quantity * (CAST(unit_price * 1000 AS BIGINT) + product_id % 10)) AS n
             FROM m_items LEFT JOIN m_products USING (product_id) GROUP BY order_id),
cents AS (SELECT order_id, n // 10 + CASE WHEN n % 10 > 5 OR (n % 10 = 5 AND n // 10 % 2 = 1) THEN 1 ELSE 0 END AS n FROM tenths)
SELECT order_id, CAST(order_total AS DOUBLE) AS order_total, CAST(ifnull(n, 0) AS DOUBLE) / 100 AS rollup_total,
       CAST(order_total AS DOUBLE) = CAST(ifnull(n, 0) AS DOUBLE) / 100 AS matches
  FROM m_orders LEFT JOIN cents USING (order_id)""")


def dirty_report_without_columns(cutoff) -> str:
    nothing = validate_report_sql(feature_ctes(cutoff) + ", nobody AS (SELECT * FROM features WHERE customer_id IS NULL)", "nobody")
    return dirty(f"""SELECT 'empty' AS frame, * FROM ({nothing})
UNION ALL (WITH {feature_ctes(cutoff)},
s AS (SELECT COUNT(*) AS n, COUNT(*) - COUNT(DISTINCT customer_id) AS again, COUNT(*) FILTER (order_count < 0) AS low,
             greatest(COUNT(*) - COUNT(customer_id), COUNT(*) - COUNT(order_count), COUNT(*) - COUNT(distinct_products),
                      COUNT(*) - COUNT(recency_days), COUNT(*) - COUNT(tenure_days)) AS missing FROM features)
SELECT 'narrow', 'required_columns', FALSE, 2, 2, 'all required columns present'
UNION ALL SELECT 'narrow', 'key_unique', again = 0, again, again, 'customer_id unique' FROM s
UNION ALL SELECT 'narrow', 'order_count_nonneg', low = 0, low, low, 'order_count >= 0' FROM s
UNION ALL SELECT 'narrow', 'total_spend_nonneg', FALSE, NULL, NULL, 'total_spend >= 0 (column missing)'
UNION ALL SELECT 'narrow', 'churned_binary', FALSE, NULL, NULL, 'churned in (0, 1) (column missing)'
UNION ALL SELECT 'narrow', 'non_empty', n > 0, CAST(n = 0 AS INT), n, 'at least one row' FROM s
UNION ALL SELECT 'narrow', 'null_fraction', missing / n < 0.01, missing, missing / n, 'max NULL fraction over required columns < 0.01' FROM s)""")


def dirty_score_rejects(cutoff) -> str:
    ok = " AND ".join(_ok(f) for f in REQ_FIELDS)
    why = ", ".join(f"CASE WHEN NOT {_ok(f)} THEN '{f}' END" for f in REQ_FIELDS)
    fields = ", ".join(f"CASE WHEN customer_id % {m} = 0 THEN -{f} - 1 ELSE {f} END AS {f}" for f, m in BAD_FIELDS.items())
    return dirty(f"""WITH {_requests_cte(cutoff)},
spoiled AS (SELECT customer_id, {fields} FROM req)
SELECT customer_id, {', '.join(REQ_FIELDS)}, concat_ws(',', {why}) AS reject_reason FROM spoiled WHERE NOT ({ok})""")


def csv_orders() -> str:
    return dirty(f"""WITH {ORACLE_CTES}
SELECT order_id, customer_id, order_date, CASE WHEN order_id % 31 <> 0 THEN status END AS status,
       CAST(order_total AS DOUBLE) AS order_total FROM m_orders""")


def dirty_duplicate_names() -> str:
    return """SELECT email, COUNT(*) AS n_rows FROM (
  SELECT lower(CASE WHEN c_custkey % 90 = 0 THEN 'Customer#' || CAST(c_custkey % 450 AS VARCHAR) ELSE c_name END) AS email
    FROM customer) GROUP BY email HAVING COUNT(*) > 1"""


def fitted_scaler(cutoff) -> str:
    return f"SELECT feature, mean, std_sample AS std FROM ({scaler_stats(cutoff)})"
