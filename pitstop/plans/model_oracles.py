"""DuckDB twins of the fitted models: the whole fit, step by step, as a chain
of CTEs.  Written from the definitions, not from the Spark plans: Newton's
steps solve their system by elimination in lists, trees take their best split
with windows over the histogram."""

from __future__ import annotations

from pitstop.plans.oracles import FEATURES, REQ_DEFAULTS, REQ_FIELDS, _ok, _requests_cte, stratified_split

NEWTON_STEPS = 12


def split_ctes(cutoff) -> str:
    """tr (all rows with is_test), train and test."""
    split = stratified_split(cutoff)
    head, _, last = split.rpartition("\nSELECT ")
    return f"""{head.removeprefix('WITH ')},
parted AS (SELECT {last}),
train AS (SELECT tr.* FROM tr JOIN parted USING (customer_id) WHERE NOT is_test),
test AS (SELECT tr.* FROM tr JOIN parted USING (customer_id) WHERE is_test)"""


def _vector(row: str = "", stats: str = "st") -> str:
    parts = [f"CASE WHEN ifnull({stats}.s{k}, 0) = 0 THEN 0 ELSE ({row}{f} - {stats}.m{k}) / {stats}.s{k} END" for k, f in enumerate(FEATURES)]
    return f"CAST([1, {', '.join(parts)}] AS DOUBLE[])"


def newton_ctes(rel: str = "train", c: float = 1.0, steps: int = NEWTON_STEPS) -> str:
    """fitted: one row (w, the weights with the intercept first, and g, the gradient there)."""
    k = len(FEATURES) + 1
    moments = ", ".join(f"avg(CAST({f} AS DOUBLE)) AS m{j}, stddev_samp(CAST({f} AS DOUBLE)) AS s{j}" for j, f in enumerate(FEATURES))
    out = [f"st AS (SELECT {moments} FROM {rel})",
           f"xs AS MATERIALIZED (SELECT CAST(churned AS DOUBLE) AS y, {_vector()} AS x FROM {rel}, st)",
           f"w0 AS MATERIALIZED (SELECT CAST({[0] * k} AS DOUBLE[]) AS w)"]

    def system(name: str, weights: str) -> str:
        ridge = lambda i: f" + {1 / c!r}" if i > 1 else ""
        pull = lambda i: f" - {1 / c!r} * any_value(w)[{i}]" if i > 1 else ""
        rows = ["[" + ", ".join([f"sum(v * x[{i}] * x[{j}]){ridge(i) if i == j else ''}" for j in range(1, k + 1)]
                                + [f"sum((y - p) * x[{i}]){pull(i)}"]) + "]" for i in range(1, k + 1)]
        return (f"{name} AS MATERIALIZED (SELECT any_value(w) AS w, [{', '.join(rows)}] AS m FROM "
                f"(SELECT *, p * (1 - p) AS v FROM (SELECT w, x, y, 1 / (1 + exp(-list_dot_product(w, x))) AS p FROM xs, {weights})))")

    for s in range(1, steps + 1):
        out.append(system(f"a{s}_0", f"w{s - 1}"))
        for i in range(1, k + 1):
            out.append(f"a{s}_{i} AS MATERIALIZED (SELECT w, [[CASE WHEN r = {i} THEN m[{i}][c] / m[{i}][{i}] "
                       f"ELSE m[r][c] - m[r][{i}] * m[{i}][c] / m[{i}][{i}] END for c in range(1, {k + 2})] for r in range(1, {k + 1})] AS m "
                       f"FROM a{s}_{i - 1})")
        out.append(f"w{s} AS MATERIALIZED (SELECT [w[r] + m[r][{k + 1}] for r in range(1, {k + 1})] AS w FROM a{s}_{k})")
    out.append(system("last", f"w{steps}"))
    out.append(f"fitted AS MATERIALIZED (SELECT w, [row[{k + 1}] for row in m] AS g FROM last)")
    return ",\n".join(out)


def logistic_weights(cutoff) -> str:
    terms = str(["intercept", *FEATURES])
    return f"""WITH {split_ctes(cutoff)}, {newton_ctes()}
SELECT unnest({terms}) AS term, ROUND(unnest(w), 6) AS weight, ROUND(abs(unnest(g)), 6) AS gradient_size FROM fitted"""


def _metrics(scored: str) -> str:
    """metric, value over a relation (churned, score)."""
    return f"""WITH_SCORES,
confusion AS (SELECT CAST(COUNT(*) FILTER (churned = 1 AND score >= 0.5) AS DOUBLE) AS tp, CAST(COUNT(*) FILTER (churned <> 1 AND score >= 0.5) AS DOUBLE) AS fp,
                     CAST(COUNT(*) FILTER (churned = 1 AND score < 0.5) AS DOUBLE) AS fn, COUNT(*) AS n FROM {scored}),
ranks AS (SELECT churned, rank() OVER (ORDER BY score) + (COUNT(*) OVER (PARTITION BY score) - 1) / 2 AS r FROM {scored}),
auc AS (SELECT (SUM(r) FILTER (churned = 1) - p * (p + 1) / 2) / (p * (COUNT(*) - p)) AS auc
        FROM ranks, (SELECT CAST(COUNT(*) AS DOUBLE) AS p FROM {scored} WHERE churned = 1) GROUP BY p)
SELECT 'accuracy' AS metric, ROUND((n - fp - fn) / n, 9) AS value FROM confusion
UNION ALL SELECT 'precision', ROUND(CASE WHEN tp + fp = 0 THEN 0 ELSE tp / (tp + fp) END, 9) FROM confusion
UNION ALL SELECT 'recall', ROUND(CASE WHEN tp + fn = 0 THEN 0 ELSE tp / (tp + fn) END, 9) FROM confusion
UNION ALL SELECT 'f1', ROUND(CASE WHEN tp = 0 THEN 0 ELSE 2 * tp / (2 * tp + fp + fn) END, 9) FROM confusion
UNION ALL SELECT 'roc_auc', ROUND(auc, 9) FROM auc"""


def logistic_metrics(cutoff) -> str:
    scores = (f"WITH {split_ctes(cutoff)}, {newton_ctes()},\n"
              f"scored AS MATERIALIZED (SELECT churned, ROUND(1 / (1 + exp(-list_dot_product(w, {_vector('test.')}))), 9) AS score FROM test, st, fitted)")
    return _metrics("scored").replace("WITH_SCORES", scores)


def batch_scores_logistic(cutoff, source: str = "fitted:newton") -> str:
    """Accepted requests scored by the weights fitted on the train split."""
    used = ", ".join(f"CASE WHEN {f} IS NULL THEN '{f}' END" for f in REQ_FIELDS)
    filled = ", ".join(f"COALESCE({f}, {REQ_DEFAULTS[f]}) AS {f}" for f in REQ_FIELDS)
    requests = _requests_cte(cutoff)
    return f"""WITH {split_ctes(cutoff)}, {newton_ctes()},
{requests[requests.index("req AS ("):]},
filled AS (SELECT customer_id, {filled}, concat_ws(',', {used}) AS used_defaults FROM req WHERE {' AND '.join(_ok(f) for f in REQ_FIELDS)}),
scored AS (SELECT filled.*, 1 / (1 + exp(-list_dot_product(w, {_vector('filled.')}))) AS s FROM filled, st, fitted)
SELECT customer_id, {', '.join(REQ_FIELDS)}, CAST(round_even(s, 4) AS DOUBLE) AS churn_probability,
       CASE WHEN s >= 0.5 THEN 1 ELSE 0 END AS churn_prediction, '{source}' AS model_source, used_defaults FROM scored"""


def streaming_scores_logistic(cutoff) -> str:
    head, _, _ = batch_scores_logistic(cutoff).rpartition("\nSELECT ")
    return f"{head}\nSELECT customer_id, {', '.join(REQ_FIELDS)}, ROUND(s, 9) AS churn_probability FROM scored"


def boosting_ctes(trees: int, depth: int, rate: float, max_bins: int, unit: int, digits: int = 6) -> str:
    """All rows, learned from or not, through the trees (rows0, ...); split_t_l
    and leaf_t of each tree."""
    probs = "[" + ", ".join(repr(k / max_bins) for k in range(1, max_bins)) + "]"
    edges = ", ".join(f"list_sort(list_distinct([round(q, {digits}) for q in quantile_cont(CAST({f} AS DOUBLE), {probs})])) AS e{k}"
                      for k, f in enumerate(FEATURES))
    codes = ", ".join(f"len([e for e in e{k} if e <= {f}])" for k, f in enumerate(FEATURES))
    out = [f"cuts AS MATERIALIZED (SELECT {edges} FROM train)",
           f"prior AS (SELECT ln(SUM(churned) / (COUNT(*) - SUM(churned))) AS m FROM train)",
           f"rows0 AS MATERIALIZED (SELECT customer_id AS id, churned AS y, is_test, [{codes}] AS b, m FROM (SELECT tr.*, is_test FROM tr JOIN parted USING (customer_id)), cuts, prior)"]
    for t in range(trees):
        out.append(f"""place{t}_0 AS MATERIALIZED (SELECT id, y, is_test, b, m, CAST(1 AS BIGINT) AS node, CAST(floor((p - y) * {unit} + 0.5) AS BIGINT) AS g,
       CAST(floor(p * (1 - p) * {unit} + 0.5) AS BIGINT) AS h FROM (SELECT *, 1 / (1 + exp(-m)) AS p FROM rows{t}))""")
        for level in range(depth):
            out.append(f"""split{t}_{level} AS MATERIALIZED (
  SELECT node, f, bin FROM (
    SELECT *, row_number() OVER (PARTITION BY node ORDER BY gain DESC, f, bin) AS best FROM (
      SELECT *, gl * gl / greatest(hl, 1) + (ga - gl) * (ga - gl) / greatest(ha - hl, 1) - ga * ga / greatest(ha, 1) AS gain FROM (
        SELECT node, f, bin, CAST(SUM(g) OVER line AS DOUBLE) AS gl, CAST(SUM(h) OVER line AS DOUBLE) AS hl,
               CAST(SUM(g) OVER whole AS DOUBLE) AS ga, CAST(SUM(h) OVER whole AS DOUBLE) AS ha, MAX(bin) OVER whole AS top
        FROM (SELECT node, f, b[f + 1] AS bin, SUM(g) AS g, SUM(h) AS h
              FROM place{t}_{level}, (SELECT unnest(range({len(FEATURES)})) AS f) WHERE NOT is_test GROUP BY node, f, bin)
        WINDOW whole AS (PARTITION BY node, f), line AS (PARTITION BY node, f ORDER BY bin)) WHERE bin < top) WHERE gain > 0) WHERE best = 1)""")
            out.append(f"""place{t}_{level + 1} AS MATERIALIZED (
  SELECT r.* REPLACE (CASE WHEN s.f IS NULL THEN r.node ELSE 2 * r.node + CAST(b[s.f + 1] > s.bin AS INT) END AS node)
  FROM place{t}_{level} r LEFT JOIN split{t}_{level} s ON s.node = r.node)""")
        out.append(f"leaf{t} AS MATERIALIZED (SELECT node, -(CAST(SUM(g) AS DOUBLE) / CAST(greatest(SUM(h), 1) AS DOUBLE)) * {rate!r} AS weight "
                   f"FROM place{t}_{depth} WHERE NOT is_test GROUP BY node)")
        out.append(f"rows{t + 1} AS MATERIALIZED (SELECT id, y, is_test, b, m + weight AS m FROM place{t}_{depth} JOIN leaf{t} USING (node))")
    return ",\n".join(out)


def boosted_trees(cutoff, trees: int, depth: int, rate: float, max_bins: int, unit: int) -> str:
    names = ", ".join(f"'{f}'" for f in FEATURES)
    parts = []
    for t in range(trees):
        for level in range(depth):
            # A node that stays whole is looked at again a level lower; its number tells the level.
            parts.append(f"SELECT {t} AS tree, node, [{names}][f + 1] AS feature, [e0, e1, e2, e3, e4][f + 1][bin + 1] AS threshold, "
                         f"NULL AS weight FROM split{t}_{level}, cuts")
        parts.append(f"SELECT {t}, node, NULL, NULL, ROUND(weight, 6) FROM leaf{t}")
    return (f"WITH {split_ctes(cutoff)}, {boosting_ctes(trees, depth, rate, max_bins, unit)}\n"
            f"SELECT CAST(tree AS BIGINT) AS tree, CAST(node AS BIGINT) AS node, feature, CAST(threshold AS DOUBLE) AS threshold, "
            f"CAST(weight AS DOUBLE) AS weight FROM ({' UNION ALL '.join(parts)})")


def boosted_metrics(cutoff, trees: int, depth: int, rate: float, max_bins: int, unit: int) -> str:
    scores = (f"WITH {split_ctes(cutoff)}, {boosting_ctes(trees, depth, rate, max_bins, unit)},\n"
              f"scored AS MATERIALIZED (SELECT y AS churned, ROUND(1 / (1 + exp(-m)), 9) AS score FROM rows{trees} WHERE is_test)")
    return _metrics("scored").replace("WITH_SCORES", scores)


def _both(cutoff, trees: int, depth: int, rate: float, max_bins: int, unit: int) -> str:
    """named: model, metric, value of both models, and chosen: the name of the better."""
    boosted = boosted_metrics(cutoff, trees, depth, rate, max_bins, unit)
    return f"""WITH named AS (
    SELECT 'baseline_logreg' AS model, * FROM ({logistic_metrics(cutoff)})
    UNION ALL SELECT 'gradient_boosting', * FROM ({boosted})
),
chosen AS (SELECT arg_max(model, (value, model = 'gradient_boosting')) AS best FROM named WHERE metric = 'roc_auc')"""


def model_choice(cutoff, trees: int, depth: int, rate: float, max_bins: int, unit: int) -> str:
    return f"""{_both(cutoff, trees, depth, rate, max_bins, unit)}
SELECT model, metric, value, model = best AS selected FROM named, chosen"""


def run_records(cutoff, baseline: dict, boosted: dict, trees: int, depth: int, rate: float, max_bins: int, unit: int) -> str:
    params = ", ".join(f"('{m}', '{k}', {float(v)!r})" for m, ps in (("baseline_logreg", baseline), ("gradient_boosting", boosted))
                       for k, v in {**ps, "n_features": len(FEATURES)}.items())
    return f"""{_both(cutoff, trees, depth, rate, max_bins, unit)},
records AS (SELECT model, 'metric' AS kind, metric AS name, value FROM named
            UNION ALL SELECT model, 'param', name, CAST(value AS DOUBLE) FROM (VALUES {params}) AS p(model, name, value))
SELECT model, kind, name, value, model = best AS selected, DATE '{cutoff.isoformat()}' AS cutoff_date FROM records, chosen"""
