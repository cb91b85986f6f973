"""SQL twins of the named queries, for an independent engine (DuckDB).

The views ``orders``, ``lineitem``, ``events`` … are the input tables. Every
string here recomputes its query from those tables alone — fixture, split,
fitted statistics, scoring, metrics — so a match is a check of the Spark
plan, not of shared code. DuckDB number literals are DECIMAL, so every
literal in arithmetic is written ``…::DOUBLE``.
"""

from __future__ import annotations

from keelson.plans import catalog as cat
from keelson.plans.fixtures import FEATURES, FOLD_SEED, SPLIT_SEED
from keelson.sources import inference


def hash_unit(key: str, seed) -> str:
    return (f"(CAST(('0x' || substr(md5('{seed}:' || coalesce(CAST({key} AS VARCHAR), '<null>')), 1, 8)) AS BIGINT)::DOUBLE"
            f" / 4294967296.0::DOUBLE)")


MODEL_ROWS = f"""model_rows AS (
  SELECT o_orderkey AS id,
         CASE WHEN o_orderkey % 311 <> 0 THEN o_totalprice / 1000.0::DOUBLE END AS price,
         CAST(month(o_orderdate) AS INTEGER) AS month,
         CASE WHEN o_orderkey % 7 <> 0
              THEN CAST(date_diff('day', CAST(o_orderdate AS DATE), DATE '2002-01-01') AS DOUBLE) END AS age_days,
         o_orderpriority AS priority,
         CASE WHEN o_orderkey % 89 <> 0 THEN o_orderstatus END AS status,
         CASE WHEN 1.8::DOUBLE * (CASE WHEN o_orderpriority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END)
                   + 0.006::DOUBLE * (o_totalprice / 1000.0::DOUBLE)
                   - 0.3::DOUBLE * CAST(month(o_orderdate) AS DOUBLE)
                   + 2.0::DOUBLE * ({hash_unit('o_orderkey', 7)} - 0.5::DOUBLE) > 0
              THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS label
  FROM orders
)"""

MR_COLS = "id, price, month, age_days, priority, status, label"

TAGGED = f"""tagged AS (
  SELECT *, CASE WHEN {hash_unit('id', SPLIT_SEED)} < {cat.TEST_SIZE}::DOUBLE THEN 'test' ELSE 'train' END AS split
  FROM model_rows
)"""

DIRTY_EVENTS = """dirty AS (
  SELECT event_id,
         CASE WHEN event_id % 17 <> 0 THEN event_type END AS event_type,
         CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END AS value,
         CAST(user_id AS VARCHAR) AS user_id
  FROM events
)"""


def _mode_cte(name: str, col: str, src: str, where: str = "TRUE") -> str:
    return f"""{name} AS (
  SELECT {col} AS v FROM {src} WHERE {where} AND {col} IS NOT NULL
  GROUP BY {col} ORDER BY count(*) DESC, {col} LIMIT 1
)"""


def _index_cte(name: str, col: str, src: str, where: str = "TRUE") -> str:
    """Frequency-descending index, ties alphabetical; values as DOUBLE."""
    return f"""{name} AS (
  SELECT v, CAST(row_number() OVER (ORDER BY n DESC, v) - 1 AS DOUBLE) AS idx
  FROM (SELECT {col} AS v, count(*) AS n FROM {src} WHERE {where} AND {col} IS NOT NULL GROUP BY {col})
)"""


def _indexed(col: str, idx: str) -> str:
    """Index lookup; unseen or null → number of labels (``keep``)."""
    return f"coalesce({idx}.idx, (SELECT CAST(count(*) AS DOUBLE) FROM {idx}))"


# Preprocessing fitted on the training split, applied to every row.
def _feature_table_ctes(stat: str = "avg") -> str:
    return f"""{MODEL_ROWS},
{TAGGED},
stats AS (
  SELECT {stat}(price) AS m_price, {stat}(CAST(month AS DOUBLE)) AS m_month, {stat}(age_days) AS m_age
  FROM tagged WHERE split = 'train'
),
{_mode_cte('priority_mode', 'priority', 'tagged', "split = 'train'")},
{_mode_cte('status_mode', 'status', 'tagged', "split = 'train'")},
filled AS (
  SELECT t.id, t.split, t.label,
         coalesce(t.price, s.m_price) AS price,
         coalesce(CAST(t.month AS DOUBLE), s.m_month) AS month,
         coalesce(t.age_days, s.m_age) AS age_days,
         coalesce(t.priority, (SELECT v FROM priority_mode)) AS priority,
         coalesce(t.status, (SELECT v FROM status_mode)) AS status
  FROM tagged t CROSS JOIN stats s
),
{_index_cte('priority_idx', 'priority', 'filled', "split = 'train'")},
{_index_cte('status_idx', 'status', 'filled', "split = 'train'")},
feature_table AS (
  SELECT f.id, f.split, f.price, f.month, f.age_days,
         {_indexed('priority', 'priority_idx')} AS priority_index,
         {_indexed('status', 'status_idx')} AS status_index,
         f.label
  FROM filled f
  LEFT JOIN priority_idx ON f.priority = priority_idx.v
  LEFT JOIN status_idx ON f.status = status_idx.v
)"""


FEATURE_TABLE_CTES = _feature_table_ctes("avg")


def _linear_z() -> str:
    z = f"{cat.LINEAR_INTERCEPT}::DOUBLE"
    for c, b in cat.LINEAR_COEFFICIENTS.items():
        z = f"({z} + {b}::DOUBLE * {c})"
    return z


LINEAR_CTES = f"""{FEATURE_TABLE_CTES},
linear AS (
  SELECT id, split, label, 1.0::DOUBLE / (1.0::DOUBLE + exp(-{_linear_z()})) AS probability
  FROM feature_table
),
linear_scored AS (
  SELECT id, split, label, probability,
         CASE WHEN probability > 0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM linear
),
test_scored AS (SELECT * FROM linear_scored WHERE split = 'test')"""


def _metrics_ctes(src: str, by: str) -> str:
    """Confusion counts → per-class counts → weighted F1 and accuracy per ``by``."""
    return f"""cm AS (
  SELECT {by}, label, prediction, count(*) AS n FROM {src} GROUP BY {by}, label, prediction
),
roles AS (
  SELECT {by}, label AS c, n AS a, 0 AS p, CASE WHEN label = prediction THEN n ELSE 0 END AS t FROM cm
  UNION ALL
  SELECT {by}, prediction AS c, 0 AS a, n AS p, 0 AS t FROM cm
),
per_class AS (
  SELECT {by}, c, CAST(sum(a) AS DOUBLE) AS a, CAST(sum(p) AS DOUBLE) AS p, CAST(sum(t) AS DOUBLE) AS t
  FROM roles GROUP BY {by}, c
),
met AS (
  SELECT {by},
         sum(CASE WHEN a + p > 0 THEN 2.0::DOUBLE * a * t / (a + p) ELSE 0.0::DOUBLE END) / sum(a) AS f1,
         sum(t) / sum(a) AS accuracy,
         CAST(sum(a) AS BIGINT) AS n
  FROM per_class GROUP BY {by}
)"""


def _logreg_ctes(reg: float, steps: int = 12) -> str:
    """Ridge logistic regression on the training split by Newton steps.

    ``newton`` is a recursive CTE: each step sums the d x d normal equations over the
    standardised rows and solves them by Gauss-Jordan elimination on lists.
    ``coefficients (b)`` has one list: the intercept, then the features.
    """
    d = len(FEATURES)
    z = ["1.0::DOUBLE", *(f"(t.{f} - s.m{i}) / s.d{i}" for i, f in enumerate(FEATURES, 1))]
    margin = " + ".join(f"n.b[{i + 1}] * z.z{i}" for i in range(d + 1))
    grad = [f"sum((p - y) * z{i}) / count(*)" + (f" + {reg}::DOUBLE * any_value(b[{i + 1}])" if i else "") for i in range(d + 1)]
    sums = {(i, j): f"sum(p * (1 - p) * z{i} * z{j}) / count(*)" for i in range(d + 1) for j in range(i, d + 1)}
    curve = [[sums[min(i, j), max(i, j)] + (f" + {reg}::DOUBLE" if i == j and i else "") for j in range(d + 1)] for i in range(d + 1)]
    matrix = "[" + ", ".join("[" + ", ".join([*row, f"-({g})"]) + "]" for row, g in zip(curve, grad)) + "]"
    solved = f"(SELECT k, b, m FROM (SELECT k, any_value(b) AS b, {matrix} AS m FROM odds GROUP BY k))"
    for i in range(1, d + 2):
        solved = (f"(SELECT k, b, list_transform(m, lambda r, i: CASE WHEN i = {i}"
                  f" THEN list_transform(r, lambda v: v / m[{i}][{i}])"
                  f" ELSE list_transform(r, lambda v, j: v - r[{i}] / m[{i}][{i}] * m[{i}][j]) END) AS m FROM {solved})")
    stats = ", ".join(f"avg({f}) AS m{i}, stddev_samp({f}) AS d{i}" for i, f in enumerate(FEATURES, 1))
    betas = ", ".join(f"n.b[{i + 1}] / s.d{i}" for i in range(1, d + 1))
    intercept = "n.b[1] - (" + " + ".join(f"n.b[{i + 1}] * s.m{i} / s.d{i}" for i in range(1, d + 1)) + ")"
    return f"""{FEATURE_TABLE_CTES},
moments AS (SELECT {stats} FROM feature_table WHERE split = 'train'),
z AS (
  SELECT t.label AS y, {", ".join(f"{e} AS z{i}" for i, e in enumerate(z))}
  FROM feature_table t CROSS JOIN moments s WHERE t.split = 'train'
),
newton(k, b) AS (
  SELECT 0, list_transform(range({d + 1}), lambda i: 0.0::DOUBLE)
  UNION ALL
  SELECT k + 1, list_transform(b, lambda v, i: v + m[i][{d + 2}]) FROM (
    WITH odds AS (SELECT n.k, n.b, z.*, 1 / (1 + exp(-({margin}))) AS p FROM newton n CROSS JOIN z WHERE n.k < {steps})
    SELECT * FROM {solved}
  )
),
coefficients AS (
  SELECT [{intercept}, {betas}] AS b FROM newton n CROSS JOIN moments s WHERE n.k = {steps}
),
model_scored AS (
  SELECT id, split, label, probability,
         CASE WHEN probability > 0.5::DOUBLE THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS prediction
  FROM (SELECT t.id, t.split, t.label, 1 / (1 + exp(-(c.b[1] + {" + ".join(f"c.b[{i + 1}] * t.{f}" for i, f in enumerate(FEATURES, 1))}))) AS probability
        FROM feature_table t CROSS JOIN coefficients c)
)"""


def _logreg_report(reg: float) -> str:
    """``evaluate_model``'s row for that regression on the test split."""
    test = "(SELECT 1 AS g, * FROM model_scored WHERE split = 'test')"
    return _w(f"{_logreg_ctes(reg)},\n{_metrics_ctes(test, 'g')}", """
        SELECT 'logreg' AS algorithm, 'LogisticRegressionModel' AS model_class, round(f1, 6) AS f1,
               round(accuracy, 6) AS accuracy, n,
               (SELECT count(*) FROM per_class WHERE p > 0) = 1 AS degenerate,
               CASE WHEN accuracy = 0 THEN 'incompatible' WHEN accuracy > 0.95 THEN 'leakage_suspected' ELSE 'ok' END AS sanity
        FROM met""").replace("WITH ", "WITH RECURSIVE ", 1)


def _scorer_grid_cte() -> str:
    parts = ["SELECT 'linear' AS scorer, 0 AS seq, id, label, prediction FROM ts"]
    seq = 1
    for k in cat.RUN_MODS:
        parts.append(f"SELECT 'mod_{k}', {seq}, id, label, CASE WHEN id % {k} = 0 THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM ts")
        seq += 1
    parts.append(f"SELECT 'constant_0', {seq}, id, label, 0.0::DOUBLE FROM ts")
    parts.append(f"SELECT 'constant_1', {seq + 1}, id, label, 1.0::DOUBLE FROM ts")
    parts.append(f"SELECT 'alternating', {seq + 2}, id, label, CAST(id % 2 AS DOUBLE) FROM ts")
    parts.append(f"SELECT 'urgent_rule', {seq + 3}, id, label, "
                 f"CASE WHEN priority = '1-URGENT' THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END FROM ts")
    body = "\n  UNION ALL ".join(parts)
    return f"""ts AS (
  SELECT t.id, t.label, t.prediction, m.priority FROM test_scored t JOIN model_rows m ON t.id = m.id
),
grid AS (
  {body}
)"""


RUNS_CTES = f"""{LINEAR_CTES},
{_scorer_grid_cte()},
{_metrics_ctes('grid', 'scorer, seq')},
runs AS (
  SELECT md5('{cat.EXPERIMENT}' || ':' || scorer) AS run_id,
         md5('{cat.EXPERIMENT}' || ':' || 'parent') AS parent_run_id,
         '{cat.EXPERIMENT}' AS experiment, scorer AS name, CAST(seq AS BIGINT) AS seq, f1, accuracy
  FROM met
)"""


def _drift_pair_sources() -> tuple[str, str]:
    pairs = [
        ("orders_half_year",
         "SELECT o_totalprice AS x FROM orders WHERE month(o_orderdate) <= 6",
         "SELECT o_totalprice AS x FROM orders WHERE month(o_orderdate) > 6"),
        ("lineitem_quantity_shift",
         "SELECT l_quantity AS x FROM lineitem WHERE l_quantity < 30",
         "SELECT l_quantity AS x FROM lineitem WHERE l_quantity >= 15"),
        ("events_click_view",
         "SELECT value AS x FROM events WHERE event_type = 'click'",
         "SELECT value AS x FROM events WHERE event_type = 'view'"),
        ("lineitem_discount_flag",
         "SELECT l_discount AS x FROM lineitem WHERE l_returnflag = 'A'",
         "SELECT l_discount AS x FROM lineitem WHERE l_returnflag = 'N'"),
        ("lineitem_constant",
         "SELECT l_quantity AS x FROM lineitem WHERE l_quantity = 7",
         "SELECT l_quantity AS x FROM lineitem WHERE l_quantity = 8"),
    ]
    base = "\n  UNION ALL ".join(f"SELECT '{n}' AS feature, CAST(x AS DOUBLE) AS x FROM ({b})" for n, b, _ in pairs)
    cur = "\n  UNION ALL ".join(f"SELECT '{n}' AS feature, CAST(x AS DOUBLE) AS x FROM ({c})" for n, _, c in pairs)
    return base, cur


def _drift_ctes(base: str, cur: str) -> str:
    """PSI chain over ``base`` / ``cur`` row sources of ``(feature, x)``."""
    probs = ", ".join(f"({i}::DOUBLE * 0.1::DOUBLE)" for i in range(10)) + ", 1.0::DOUBLE"
    return f"""base AS (
  {base}
),
cur AS (
  {cur}
),
edges AS (
  SELECT feature, list_sort(list_distinct(quantile_cont(x, [{probs}]))) AS edges
  FROM base WHERE x IS NOT NULL AND NOT isnan(x) GROUP BY feature
),
bins AS (
  SELECT feature, CAST(unnest(range(0, len(edges) - 1)) AS INTEGER) AS bin FROM edges
),
base_binned AS (
  SELECT b.feature,
         CASE WHEN b.x IS NOT NULL AND NOT isnan(b.x) AND e.edges IS NOT NULL THEN
           CAST(greatest(0, least(len(list_filter(e.edges, lambda t: t <= b.x)) - 1, len(e.edges) - 2)) AS INTEGER) END AS bin
  FROM base b LEFT JOIN edges e ON b.feature = e.feature
),
cur_binned AS (
  SELECT c.feature,
         CASE WHEN c.x IS NULL OR isnan(c.x) THEN NULL WHEN e.edges IS NULL THEN -1 ELSE
           CAST(greatest(0, least(len(list_filter(e.edges, lambda t: t <= c.x)) - 1, len(e.edges) - 2)) AS INTEGER) END AS bin
  FROM cur c LEFT JOIN edges e ON c.feature = e.feature
),
base_counts AS (SELECT feature, bin, count(*) AS n FROM base_binned GROUP BY feature, bin),
cur_counts AS (SELECT feature, bin, count(*) AS n FROM cur_binned GROUP BY feature, bin),
base_tot AS (
  SELECT feature, sum(CASE WHEN bin IS NOT NULL THEN n ELSE 0 END) AS tot, sum(n) AS all_n
  FROM base_counts GROUP BY feature
),
cur_tot AS (
  SELECT feature, sum(CASE WHEN bin IS NOT NULL THEN n ELSE 0 END) AS tot, sum(n) AS all_n
  FROM cur_counts GROUP BY feature
),
features AS (SELECT feature FROM base_tot UNION SELECT feature FROM cur_tot),
shares AS (
  SELECT bins.feature, bins.bin,
         greatest(CASE WHEN coalesce(bt.tot, 0) > 0 THEN coalesce(bc.n, 0) / CAST(bt.tot AS DOUBLE) ELSE 0.0::DOUBLE END,
                  1e-6::DOUBLE) AS e,
         greatest(CASE WHEN coalesce(ct.tot, 0) > 0 THEN coalesce(cc.n, 0) / CAST(ct.tot AS DOUBLE) ELSE 0.0::DOUBLE END,
                  1e-6::DOUBLE) AS a
  FROM bins
  LEFT JOIN base_counts bc ON bins.feature = bc.feature AND bins.bin = bc.bin
  LEFT JOIN cur_counts cc ON bins.feature = cc.feature AND bins.bin = cc.bin
  LEFT JOIN base_tot bt ON bins.feature = bt.feature
  LEFT JOIN cur_tot ct ON bins.feature = ct.feature
),
psi AS (SELECT feature, sum((a - e) * ln(a / e)) AS psi FROM shares GROUP BY feature),
report AS (
  SELECT f.feature, 'psi' AS method, coalesce(p.psi, 0.0::DOUBLE) AS psi, 0.2::DOUBLE AS threshold,
         coalesce(p.psi, 0.0::DOUBLE) > 0.2::DOUBLE OR (coalesce(bt.tot, 0) > 0) <> (coalesce(ct.tot, 0) > 0) AS drift,
         CASE WHEN coalesce(bt.all_n, 0) > 0 THEN (bt.all_n - coalesce(bt.tot, 0)) / CAST(bt.all_n AS DOUBLE) END
           AS null_share_baseline,
         CASE WHEN coalesce(ct.all_n, 0) > 0 THEN (ct.all_n - coalesce(ct.tot, 0)) / CAST(ct.all_n AS DOUBLE) END
           AS null_share_current
  FROM features f
  LEFT JOIN psi p ON f.feature = p.feature
  LEFT JOIN base_tot bt ON f.feature = bt.feature
  LEFT JOIN cur_tot ct ON f.feature = ct.feature
)"""


DRIFT_CTES = _drift_ctes(*_drift_pair_sources())


def _w(ctes: str, body: str) -> str:
    return f"WITH {ctes}\n{body}"


def _round_cols(cols, digits=6, prefix="") -> str:
    return ", ".join(f"round({prefix}{c}, {digits}) AS {c}" for c in cols)


NUM = ["price", "month", "age_days"]


def _impute_numeric(stat: str) -> str:
    stats = ", ".join(f"{stat}(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUM)
    filled = ", ".join(f"round(coalesce(CAST(m.{c} AS DOUBLE), s.m_{c}, 0.0::DOUBLE), 6) AS {c}" for c in NUM)
    return _w(f"{MODEL_ROWS},\ns AS (SELECT {stats} FROM model_rows)",
              f"SELECT m.id, {filled} FROM model_rows m CROSS JOIN s")


def _one_hot_sql() -> str:
    # One slot for each label and one for null and unseen values.
    ctes = [MODEL_ROWS, _index_cte("priority_idx", "priority", "model_rows"), _index_cte("status_idx", "status", "model_rows"),
            f"""idx AS (
  SELECT m.id, {_indexed('priority', 'priority_idx')} AS pi, {_indexed('status', 'status_idx')} AS si
  FROM model_rows m LEFT JOIN priority_idx ON m.priority = priority_idx.v LEFT JOIN status_idx ON m.status = status_idx.v
)"""]
    cols = []
    for col, short, n in (("priority", "pi", 5), ("status", "si", 3)):
        for i in range(n + 1):
            cols.append(f"CASE WHEN {short} = {i} THEN 1.0::DOUBLE ELSE 0.0::DOUBLE END AS {col}_{i}")
    return _w(",\n".join(ctes), f"SELECT id, {', '.join(cols)} FROM idx")


def oracle_sql() -> dict[str, str]:
    mr = lambda body: _w(MODEL_ROWS, body)
    ft_cols = ", ".join(FEATURES)
    q: dict[str, str] = {}

    # 2.1 sources and sinks (round trips return the rows written)
    q["scan_parquet"] = mr(f"SELECT {MR_COLS} FROM model_rows")
    q["write_parquet"] = q["scan_parquet"]
    q["scan_csv"] = q["scan_parquet"]
    q["save_model"] = _w(f"{MODEL_ROWS},\n{TAGGED}", "SELECT id, true AS same FROM tagged WHERE split = 'test'")
    q["write_csv_predictions"] = mr(f"SELECT id, CAST(id % {cat.MOD_K} = 0 AS INTEGER) AS prediction FROM model_rows")
    q["write_report_json"] = _w(f"{LINEAR_CTES},\n{_metrics_ctes('(SELECT 1 AS g, * FROM test_scored)', 'g')}",
                                "SELECT 'linear' AS algorithm, round(f1, 6) AS f1, round(accuracy, 6) AS accuracy FROM met")

    # 2.6 to 2.8: the regression's optimum does not depend on who finds it
    fitted = lambda body, reg=0.01: _w(_logreg_ctes(reg), body).replace("WITH ", "WITH RECURSIVE ", 1)
    terms = ", ".join(f"'{t}'" for t in ["intercept", *FEATURES])
    q["train_logreg"] = fitted(f"""
        SELECT term, round(coefficient, 8) AS coefficient
        FROM (SELECT unnest([{terms}]) AS term, unnest(b) AS coefficient FROM coefficients)""")
    q["score_batch"] = fitted("SELECT id, prediction, round(probability, 6) AS probability FROM model_scored")
    q["score_stream"] = q["score_batch"]
    q["evaluate_model"] = _logreg_report(0.01)
    q["train_single"] = _logreg_report(0.1)
    served = "\nUNION ALL ".join(
        f"SELECT id, CAST({i} AS INTEGER) AS version, prediction, round(probability, 6) AS probability "
        f"FROM (WITH RECURSIVE {_logreg_ctes(reg)} SELECT * FROM model_scored) WHERE id % 2 = {i - 1}"
        for i, reg in enumerate(cat.SERVED_REG, 1))
    q["score_production"] = served
    q["retrain_chain"] = f"""
        SELECT CAST(start AS INTEGER) AS start, CAST(seq AS INTEGER) AS seq, stage, start = 1 AS ran, 1 AS version, f1, accuracy
        FROM ({_logreg_report(0.01)}) r,
             (SELECT unnest(range(1, 5)) AS seq, unnest(['split', 'train', 'evaluate', 'register']) AS stage) s,
             (SELECT unnest([1, 2]) AS start) t"""
    q["train_random_forest"] = _w(f"{MODEL_ROWS},\n{TAGGED}", "SELECT id, true AS same FROM tagged WHERE split = 'test'")

    # 2.4 keyed permutations and splits of exact size
    draw = lambda seed: f"ORDER BY {hash_unit('id', seed)}, id"
    q["shuffle_rows"] = mr(f"SELECT id, label, row_number() OVER ({draw(cat.SAMPLE_SEED)}) - 1 AS position FROM model_rows")
    side = lambda over, n: (f"CASE WHEN row_number() OVER ({over} {draw(SPLIT_SEED)}) <= "  # noqa: E731
                            f"CAST(round({n} * {cat.TEST_SIZE}::DOUBLE) AS BIGINT) THEN 'test' ELSE 'train' END AS split")
    q["split_random"] = mr(f"SELECT id, {side('', 'count(*) OVER ()')} FROM model_rows")
    q["split_rand"] = mr(f"SELECT id, label, {side('PARTITION BY label', 'count(*) OVER (PARTITION BY label)')} FROM model_rows")

    # 2.2 projection, filter, schema
    q["cast_numeric"] = _w(DIRTY_EVENTS, "SELECT event_id, TRY_CAST(value AS DOUBLE) AS value_num FROM dirty")
    q["rename_label"] = mr("SELECT id, label AS target FROM model_rows")
    q["project"] = mr("SELECT id, month, priority, label FROM model_rows")
    q["filter_split"] = mr(f"SELECT {MR_COLS} FROM model_rows WHERE {hash_unit('id', SPLIT_SEED)} < {cat.TEST_SIZE}::DOUBLE")
    q["drop_columns"] = mr("SELECT id, month, priority, status, label FROM model_rows")
    checks = [
        "CASE WHEN event_type IS NULL THEN 'event_type: required' END",
        "CASE WHEN value IS NOT NULL AND TRY_CAST(value AS DOUBLE) IS NULL THEN 'value: not double' END",
    ]
    n_err = " + ".join(f"CASE WHEN {c} IS NOT NULL THEN 1 ELSE 0 END" for c in checks)
    q["contract_check"] = _w(DIRTY_EVENTS, f"""SELECT event_id, ({n_err}) = 0 AS valid, CAST({n_err} AS INTEGER) AS n_errors,
       concat_ws('; ', {', '.join(checks)}) AS errors FROM dirty""")

    # 2.3 aggregation
    q["agg_mean"] = mr("SELECT " + ", ".join(f"round(avg(CAST({c} AS DOUBLE)), 6) AS {c}" for c in NUM) + " FROM model_rows")
    q["agg_mode"] = mr("SELECT status, count(*) AS count FROM model_rows WHERE status IS NOT NULL "
                       "GROUP BY status ORDER BY count DESC, status LIMIT 1")
    q["agg_median"] = mr("SELECT round(median(price), 6) AS price, round(median(age_days), 6) AS age_days FROM model_rows")
    q["count_rows"] = mr("SELECT count(*) AS n_rows FROM model_rows")
    q["prediction_distribution"] = _w(LINEAR_CTES, "SELECT prediction, count(*) AS count FROM linear_scored GROUP BY prediction")
    q["positive_rate"] = _w(LINEAR_CTES, "SELECT round(avg(prediction), 6) AS positive_rate FROM linear_scored")
    q["category_frequency"] = mr("SELECT status, count(*) AS count FROM model_rows GROUP BY status")

    # 2.4 ordering, sampling, splitting
    q["top_1"] = mr(f"SELECT {MR_COLS} FROM model_rows ORDER BY price DESC NULLS LAST, id ASC LIMIT 1")
    q["limit_sample"] = mr(f"SELECT {MR_COLS} FROM model_rows ORDER BY {hash_unit('id', cat.SAMPLE_SEED)}, id "
                           f"LIMIT {cat.SAMPLE_SIZE}")
    q["split_hash"] = _w(f"{MODEL_ROWS},\n{TAGGED}", "SELECT id, split FROM tagged")
    q["kfold_assign"] = mr(f"SELECT id, CAST(floor({hash_unit('id', FOLD_SEED)} * 3.0::DOUBLE) AS INTEGER) AS fold "
                           "FROM model_rows")

    # 2.5 imputation and features
    q["impute_mean"] = _impute_numeric("avg")
    q["impute_median"] = _impute_numeric("median")
    q["impute_mode"] = _w(f"{MODEL_ROWS},\n{_mode_cte('pm', 'priority', 'model_rows')},\n{_mode_cte('sm', 'status', 'model_rows')}",
                          "SELECT id, coalesce(priority, (SELECT v FROM pm)) AS priority, "
                          "coalesce(status, (SELECT v FROM sm)) AS status FROM model_rows")
    q["string_index"] = _w(
        f"{MODEL_ROWS},\n{_index_cte('priority_idx', 'priority', 'model_rows')},\n{_index_cte('status_idx', 'status', 'model_rows')}",
        f"""SELECT m.id, m.priority, m.status, {_indexed('priority', 'priority_idx')} AS priority_index,
       {_indexed('status', 'status_idx')} AS status_index
FROM model_rows m LEFT JOIN priority_idx ON m.priority = priority_idx.v LEFT JOIN status_idx ON m.status = status_idx.v""")
    q["one_hot"] = _one_hot_sql()
    stats = ", ".join(f"avg(CAST({c} AS DOUBLE)) AS m_{c}" for c in NUM)
    q["assemble_features"] = _w(
        f"""{MODEL_ROWS},
s AS (SELECT {stats} FROM model_rows),
{_mode_cte('pm', 'priority', 'model_rows')},
{_mode_cte('sm', 'status', 'model_rows')},
filled AS (
  SELECT m.id, {', '.join(f'coalesce(CAST(m.{c} AS DOUBLE), s.m_{c}) AS {c}' for c in NUM)},
         coalesce(priority, (SELECT v FROM pm)) AS priority, coalesce(status, (SELECT v FROM sm)) AS status
  FROM model_rows m CROSS JOIN s
),
{_index_cte('priority_idx', 'priority', 'filled')},
{_index_cte('status_idx', 'status', 'filled')}""",
        f"""SELECT f.id, {_round_cols(NUM, prefix='f.')},
       round({_indexed('priority', 'priority_idx')}, 6) AS priority_index, round({_indexed('status', 'status_idx')}, 6) AS status_index
FROM filled f LEFT JOIN priority_idx ON f.priority = priority_idx.v LEFT JOIN status_idx ON f.status = status_idx.v""")
    q["feature_table"] = _w(FEATURE_TABLE_CTES,
                            f"SELECT id, split, {_round_cols(FEATURES)}, label FROM feature_table")
    q["feature_table_median"] = _w(_feature_table_ctes("median"),
                                   f"SELECT id, split, {_round_cols(FEATURES)}, label FROM feature_table")

    # 2.7 evaluation (linear scorer on the test split)
    one = "(SELECT 1 AS g, * FROM test_scored)"
    q["confusion_matrix"] = _w(LINEAR_CTES, "SELECT label, prediction, count(*) AS n FROM test_scored GROUP BY label, prediction")
    q["accuracy"] = _w(f"{LINEAR_CTES},\n{_metrics_ctes(one, 'g')}", "SELECT round(accuracy, 6) AS accuracy FROM met")
    q["weighted_f1"] = _w(f"{LINEAR_CTES},\n{_metrics_ctes(one, 'g')}", "SELECT round(f1, 6) AS f1 FROM met")
    q["degenerate_check"] = _w(f"{LINEAR_CTES},\n{_scorer_grid_cte()}",
                               "SELECT scorer, count(DISTINCT prediction) AS n_predicted_classes, "
                               "count(DISTINCT prediction) = 1 AS degenerate FROM grid GROUP BY scorer")
    sanity_src = """(SELECT 'linear' AS scorer, label, prediction FROM test_scored
  UNION ALL SELECT 'label_copy', label, label FROM test_scored
  UNION ALL SELECT 'label_flip', label, 1.0::DOUBLE - label FROM test_scored)"""
    q["sanity_flags"] = _w(f"{LINEAR_CTES},\n{_metrics_ctes(sanity_src, 'scorer')}",
                           """SELECT scorer, round(accuracy, 6) AS accuracy,
       CASE WHEN accuracy = 0 THEN 'incompatible' WHEN accuracy > 0.95::DOUBLE THEN 'leakage_suspected' ELSE 'ok' END
         AS sanity
FROM met""")

    # 2.8 scoring
    q["score_linear"] = _w(LINEAR_CTES, "SELECT id, round(probability, 6) AS probability, prediction FROM linear_scored")
    q["baseline_mod"] = mr(f"SELECT id, CAST(id % {cat.MOD_K} = 0 AS INTEGER) AS prediction FROM model_rows")
    q["baseline_alternating"] = mr("SELECT id, CAST(id % 2 AS INTEGER) AS prediction FROM model_rows")
    q["baseline_constant"] = mr("SELECT id, 0 AS prediction FROM model_rows")
    q["prediction_summary"] = _w(LINEAR_CTES, "SELECT 'linear' AS algorithm, count(*) AS n_predictions, "
                                              "round(avg(prediction), 6) AS positive_rate FROM linear_scored")

    # 2.9 drift
    q["vector_slot"] = _w(FEATURE_TABLE_CTES, "SELECT id, round(price, 6) AS x FROM feature_table")
    q["quantile_edges"] = _w(DRIFT_CTES, """SELECT feature, CAST(i - 1 AS INTEGER) AS edge_index, round(edges[i], 6) AS edge
FROM (SELECT feature, edges, unnest(range(1, len(edges) + 1)) AS i FROM edges)""")
    q["bucketize"] = _w(DRIFT_CTES, "SELECT feature, bin, n FROM cur_counts")
    q["bin_shares"] = _w(DRIFT_CTES, """SELECT feature, bin, round(e, 8) AS share, 'baseline' AS side FROM shares
UNION ALL SELECT feature, bin, round(a, 8) AS share, 'current' AS side FROM shares""")
    q["psi"] = _w(DRIFT_CTES, "SELECT feature, round(psi, 8) AS psi FROM report")
    q["drift_report"] = _w(DRIFT_CTES, """SELECT feature, method, round(psi, 8) AS psi, threshold, drift,
       round(null_share_baseline, 6) AS null_share_baseline, round(null_share_current, 6) AS null_share_current
FROM report""")
    slots = lambda side: "\n  UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f} AS x FROM feature_table WHERE split = '{side}'" for f in FEATURES)
    q["feature_drift"] = _w(f"{FEATURE_TABLE_CTES},\n{_drift_ctes(slots('train'), slots('test'))}",
                            """SELECT feature, method, round(psi, 8) AS psi, threshold, drift,
       round(null_share_baseline, 6) AS null_share_baseline, round(null_share_current, 6) AS null_share_current
FROM report""")
    q["drift_summary"] = _w(DRIFT_CTES, """SELECT count(*) AS n_features, count(*) FILTER (WHERE drift) AS n_drifted,
       round(max(psi), 8) AS max_psi, coalesce(bool_or(drift), false) AS any_drift FROM report""")

    start = "strftime(time_bucket(INTERVAL 5 DAY, ts, TIMESTAMP '1970-01-01'), '%Y-%m-%d')"
    arrived = " UNION ALL ".join(
        f"SELECT {start} || '|{c}' AS feature, CAST({c} AS DOUBLE) AS x, ts FROM events" for c in cat.DRIFT_COLUMNS)
    first = " UNION ALL ".join(
        f"SELECT w.s || '|{c}' AS feature, CAST({c} AS DOUBLE) AS x FROM events, (SELECT DISTINCT {start} AS s FROM events) w "
        f"WHERE ts < TIMESTAMP '{cat.DRIFT_BASELINE_END}'" for c in cat.DRIFT_COLUMNS)
    q["drift_stream"] = _w(_drift_ctes(first, f"SELECT feature, x FROM ({arrived})"), """
SELECT split_part(r.feature, '|', 1) AS window_start, split_part(r.feature, '|', 2) AS feature,
       CAST(t.tot AS BIGINT) AS n, CAST(t.all_n AS BIGINT) AS n_all, round(psi, 8) AS psi, drift,
       round(null_share_current, 6) AS null_share
FROM report r JOIN cur_tot t ON r.feature = t.feature""")

    customer = f"CASE WHEN o_orderkey % {cat.INDEX_NULL_EVERY} <> 0 THEN 'c' || CAST(o_custkey AS VARCHAR) END"
    q["string_index_table"] = f"""WITH r AS (SELECT o_orderkey AS id, {customer} AS customer FROM orders),
i AS (SELECT customer, row_number() OVER (ORDER BY count(*) DESC, customer) - 1 AS place FROM r WHERE customer IS NOT NULL GROUP BY customer)
SELECT r.id, r.customer, CAST(coalesce(i.place, (SELECT count(*) FROM i)) AS DOUBLE) AS customer_index
FROM r LEFT JOIN i ON r.customer = i.customer"""
    texts = {"event_id": "CAST(event_id AS VARCHAR)", "event_type": "CASE WHEN event_id % 17 <> 0 THEN event_type END",
             "value": "CASE WHEN event_id % 13 = 0 THEN 'bad' ELSE CAST(value AS VARCHAR) END",
             "user_id": "CAST(user_id AS VARCHAR)",
             "day": "CAST(DATE '2024-01-01' + CAST(event_id % 400 AS INTEGER) AS VARCHAR)",
             "even": "CAST(event_id % 2 = 0 AS VARCHAR)"}
    long = " UNION ALL ".join(f"SELECT '{c}' AS \"column\", {e} AS x FROM events" for c, e in texts.items())
    q["csv_evidence"] = f"""WITH x AS ({long}), c AS (
  SELECT "column", count(x) AS n, count(*) FILTER (WHERE regexp_matches(x, '{inference.LONG}')) AS n_long,
         count(*) FILTER (WHERE regexp_matches(x, '{inference.DOUBLE}')) AS n_double,
         count(*) FILTER (WHERE regexp_matches(x, '{inference.BOOLEAN}')) AS n_boolean,
         count(*) FILTER (WHERE regexp_matches(x, '{inference.DATE}') AND TRY_CAST(x AS DATE) IS NOT NULL) AS n_date
  FROM x GROUP BY "column")
SELECT *, CAST(0 AS BIGINT) AS n_corrupt, CASE WHEN n = 0 THEN 'string' WHEN n_long = n THEN 'long' WHEN n_double = n THEN 'double'
       WHEN n_boolean = n THEN 'boolean' WHEN n_date = n THEN 'date' ELSE 'string' END AS inferred FROM c"""

    # 2.10 runs, versions, retrain gate
    q["run_log"] = _w(RUNS_CTES, "SELECT run_id, parent_run_id, experiment, name, seq, round(f1, 6) AS f1, "
                                 "round(accuracy, 6) AS accuracy FROM runs")
    q["best_run"] = _w(RUNS_CTES, "SELECT run_id, name, round(f1, 6) AS f1 FROM runs ORDER BY runs.f1 DESC, seq DESC, run_id LIMIT 1")
    q["promote_version"] = _w(f"""{RUNS_CTES},
best AS (SELECT run_id FROM runs ORDER BY f1 DESC, seq DESC, run_id LIMIT 1),
versions AS (
  SELECT '{cat.MODEL_NAME}' AS name, CAST(seq + 1 AS INTEGER) AS version,
         CASE WHEN seq + 1 = 1 THEN 'Production' ELSE 'None' END AS stage, run_id
  FROM runs
)""", """SELECT name, version, CASE WHEN stage = 'Production' THEN 'Archived' ELSE stage END AS stage, run_id FROM versions
UNION ALL
SELECT '""" + cat.MODEL_NAME + """', CAST((SELECT max(version) FROM versions) + 1 AS INTEGER), 'Production', (SELECT run_id FROM best)""")
    q["retrain_gate"] = _w(DRIFT_CTES, """SELECT coalesce(bool_or(drift), false) AS any_drift, true AS retrain_enabled,
       CASE WHEN coalesce(bool_or(drift), false) THEN 'retrain' ELSE 'keep' END AS decision FROM report""")
    return q
