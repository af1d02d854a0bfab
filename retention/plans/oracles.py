"""DuckDB statements for the registered queries that SQL can express.

Written apart from the Spark code: plain definitions over whole tables, with
none of the bucketing, sketches or cuts that the operators use.
"""

from __future__ import annotations

# Column roles and labels, as in config.py.
CLASSES = ["Not Churn", "Churn"]
CATEGORICAL = [
    "gender", "SeniorCitizen", "Partner", "Dependents", "PhoneService", "MultipleLines", "InternetService",
    "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV", "StreamingMovies",
    "Contract", "PaperlessBilling", "PaymentMethod",
]
NUMERICAL = ["tenure", "MonthlyCharges", "TotalCharges"]
SERVICES = [
    "PhoneService", "MultipleLines", "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection",
    "TechSupport", "StreamingTV", "StreamingMovies",
]
TENURE_LABELS = ["0-12 months", "13-24 months", "25-36 months", "37-48 months", "49-60 months", "61-72 months"]
COUNT_LABELS = ["None", "Basic", "Medium", "High", "Complete"]
CONTRACTS = ["AUTOMOBILE", "BUILDING", "FURNITURE", "HOUSEHOLD", "MACHINERY"]

_S = ", ".join(f"bool_or(o_orderkey % 9 = {k}) AS s{k}" for k in range(9))
_NUMBER = r"^[+-]?([0-9]+\.?[0-9]*|\.[0-9]+)([eE][+-]?[0-9]+)?$"


def _yn(cond: str) -> str:
    return f"CASE WHEN {cond} THEN 'Yes' ELSE 'No' END"


def _has(k: int) -> str:
    return f"coalesce(s{k}, false)"


PROFILE = f"""
o AS (SELECT o_orderkey, o_custkey, CAST(o_orderdate AS DATE) AS d, CAST(o_totalprice AS DECIMAL(18,2)) AS price,
             o_orderpriority AS pri FROM orders),
anchor AS (SELECT max(d) AS a FROM o),
g AS (SELECT o_custkey, max(d) AS last_dt, min(d) FILTER (WHERE pri = '1-URGENT') AS first_urgent,
             sum(price) AS total, count(*) AS n,
             substr(max(strftime(d, '%Y-%m-%d') || pri), 11) AS last_pri, {_S}
      FROM o GROUP BY o_custkey),
profile AS (
  SELECT c_custkey AS customerID,
    CASE WHEN c_nationkey % 2 = 0 THEN 'Female' ELSE 'Male' END AS gender,
    CAST(c_custkey % 6 = 0 AS INTEGER) AS SeniorCitizen,
    {_yn('c_acctbal >= 4500')} AS Partner,
    {_yn('c_custkey % 10 < 3')} AS Dependents,
    CAST(coalesce(floor(date_diff('day', first_urgent, a) / CAST(30 AS DOUBLE)), 0) AS INTEGER) AS tenure,
    {_yn(_has(0))} AS PhoneService,
    CASE WHEN NOT {_has(0)} THEN 'No phone service' WHEN {_has(1)} THEN 'Yes' ELSE 'No' END AS MultipleLines,
    CASE WHEN {_has(2)} THEN 'Fiber' WHEN {_has(3)} THEN 'DSL' ELSE 'No' END AS InternetService,
    {_yn(_has(4))} AS OnlineSecurity,
    {_yn(_has(5))} AS OnlineBackup,
    CASE WHEN c_custkey % 50 = 0 THEN NULL WHEN {_has(6)} THEN 'Yes' ELSE 'No' END AS DeviceProtection,
    {_yn(_has(7))} AS TechSupport,
    {_yn(_has(8))} AS StreamingTV,
    {_yn(_has(1) + ' AND ' + _has(8))} AS StreamingMovies,
    c_mktsegment AS Contract,
    {_yn('c_custkey % 5 < 3')} AS PaperlessBilling,
    coalesce(last_pri, 'none') AS PaymentMethod,
    CASE WHEN c_custkey % 97 = 0 THEN NULL ELSE CAST(total AS DOUBLE) / (CAST(1000 AS DOUBLE) * n) END AS MonthlyCharges,
    CASE WHEN first_urgent IS NULL THEN ' ' ELSE CAST(total AS VARCHAR) END AS TotalCharges,
    {_yn("last_dt IS NULL OR date_diff('day', last_dt, a) > 270")} AS Churn
  FROM customer LEFT JOIN g ON c_custkey = o_custkey CROSS JOIN anchor)"""

CLEAN = f"""
clean AS (
  SELECT * REPLACE (
      coalesce(CASE WHEN regexp_matches(trim(TotalCharges), '{_NUMBER}') THEN CAST(trim(TotalCharges) AS DOUBLE) END, 0) AS TotalCharges,
      CASE SeniorCitizen WHEN 0 THEN 'No' WHEN 1 THEN 'Yes' END AS SeniorCitizen),
    CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS Churn_Binary
  FROM profile)"""

RANKED = """
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY Churn_Binary ORDER BY md5('42|' || CAST(customerID AS VARCHAR)), customerID) AS rk,
         count(*) OVER (PARTITION BY Churn_Binary) AS nc
  FROM clean),
exact AS (SELECT Churn_Binary AS c, count(*) * CAST(0.3 AS DOUBLE) AS x FROM clean GROUP BY Churn_Binary),
quota AS (
  SELECT c, floor(x) + CASE WHEN row_number() OVER (ORDER BY x - floor(x) DESC, c)
         <= ceil((SELECT count(*) FROM clean) * CAST(0.3 AS DOUBLE)) - sum(floor(x)) OVER () THEN 1 ELSE 0 END AS q FROM exact),
split AS (
  SELECT * EXCLUDE (rk, nc), CASE WHEN rk <= (SELECT q FROM quota WHERE c = Churn_Binary) THEN 'test' ELSE 'train' END AS split FROM ranked),
folds AS (
  SELECT * EXCLUDE (rk, nc), CAST(CAST(rk > nc * 1 // 5 AS INTEGER) + CAST(rk > nc * 2 // 5 AS INTEGER)
         + CAST(rk > nc * 3 // 5 AS INTEGER) + CAST(rk > nc * 4 // 5 AS INTEGER) AS INTEGER) AS fold FROM ranked)"""

SCORED = """
scored AS (
  SELECT customerID, Contract, model, label, p, CAST(p >= 0.5 AS INTEGER) AS prediction
  FROM (SELECT customerID, Contract, model, label,
               CAST((customerID * k) % 100 * 6 + CASE WHEN label = 1 THEN 300 ELSE 50 END AS DOUBLE) / CAST(1000 AS DOUBLE) AS p
        FROM (SELECT customerID, Contract, CASE WHEN Churn = 'Yes' THEN 1 ELSE 0 END AS label FROM profile)
        CROSS JOIN (VALUES ('m1', 7919), ('m2', 104729), ('m3', 1299709)) AS t(model, k)))"""


def _r(expr: str, digits: int = 6) -> str:
    """Rounded half up by the same double operations as on the other side."""
    scale = 10 ** digits
    return f"floor(({expr}) * CAST({scale} AS DOUBLE) + CAST(0.5 AS DOUBLE)) / CAST({scale} AS DOUBLE)"


def _with(body: str, *ctes: str) -> str:
    return "WITH " + ",".join(ctes) + "\n" + body


def _profile(body: str, *more: str) -> str:
    return _with(body, PROFILE, *more)


def _clean(body: str, *more: str) -> str:
    return _with(body, PROFILE, CLEAN, *more)


def _share(digits: int) -> str:
    """The class share of the customer's contract."""
    return _clean(f"SELECT customerID, {_r('avg(CAST(Churn_Binary AS DOUBLE)) OVER (PARTITION BY Contract)', digits)} AS p FROM clean")


def _split(body: str, *more: str) -> str:
    return _with(body, PROFILE, CLEAN, RANKED, *more)


PARTS = """
lines AS (SELECT concat_ws('-', l_orderkey, l_linenumber) AS id, l_partkey AS part FROM lineitem),
placed AS (SELECT id, part, rank() OVER (PARTITION BY part ORDER BY md5('42|' || id), id) AS place FROM lines WHERE part IS NOT NULL),
sizes AS (SELECT part, count(*) AS n, floor(count(*) * CAST(0.3 AS DOUBLE)) AS low FROM lines WHERE part IS NOT NULL GROUP BY part),
missing AS (SELECT ceil(sum(n) * CAST(0.3 AS DOUBLE)) - sum(low) AS m FROM sizes),
shares AS (SELECT part, n, low + CASE WHEN row_number() OVER (ORDER BY low - n * CAST(0.3 AS DOUBLE), part) <= m THEN 1 ELSE 0 END AS share
           FROM sizes, missing)"""


def _scored(body: str, *more: str) -> str:
    return _with(body, PROFILE, SCORED, *more)


def _bin(column: str, edges: list[int], labels: list[str]) -> str:
    cases = " ".join(
        f"WHEN {column} > {lo} AND {column} <= {hi} THEN '{label}'" for lo, hi, label in zip(edges, edges[1:], labels)
    )
    return f"CASE {cases} END"


TENURE_CASE = _bin("tenure", [0, 12, 24, 36, 48, 60, 72], TENURE_LABELS)
SERVICE_SUM = " + ".join(f"CASE WHEN {c} = 'Yes' THEN 1 ELSE 0 END" for c in SERVICES)
COUNT_CASE = _bin("service_count", [-1, 0, 2, 4, 6, 10], COUNT_LABELS)


def _ordinal(case: str, labels: list[str]) -> str:
    return "CAST(CASE " + case + " " + " ".join(f"WHEN '{x}' THEN {i}" for i, x in enumerate(labels)) + " END AS INTEGER)"


def _dummies(column: str, labels: list[str], prefix: str) -> str:
    return ", ".join(f"coalesce({column} = '{x}', false) AS \"{prefix}_{x}\"" for x in labels)


COUNTED = f"""
counted AS (SELECT *, {SERVICE_SUM} AS service_count FROM clean),
engineered AS (SELECT *, {TENURE_CASE} AS tenure_group, {COUNT_CASE} AS service_count_group,
                      CASE WHEN MonthlyCharges + 1 <> 0 THEN CAST(tenure AS DOUBLE) / (MonthlyCharges + 1) END AS ratio
               FROM counted)"""

# --- fitted preprocessing -------------------------------------------------
_NUM_LONG = " UNION ALL ".join(
    f"SELECT customerID, split, '{c}' AS feature, CAST({c} AS DOUBLE) AS v FROM split" for c in NUMERICAL
)
_CAT_LONG = " UNION ALL ".join(f"SELECT customerID, split, '{c}' AS feature, {c} AS v FROM split" for c in CATEGORICAL)
PREP = f"""
numbers AS ({_NUM_LONG}),
texts AS ({_CAT_LONG}),
medians AS (SELECT feature, median(v) AS med FROM numbers WHERE split = 'train' GROUP BY feature),
imputed AS (SELECT customerID, split, feature, coalesce(v, med) AS v FROM numbers JOIN medians USING (feature)),
moments AS (SELECT feature, avg(v) AS mean, stddev_pop(v) AS std FROM imputed WHERE split = 'train' GROUP BY feature),
category_counts AS (SELECT feature, v, count(*) AS n FROM texts WHERE split = 'train' AND v IS NOT NULL GROUP BY feature, v),
modes AS (SELECT feature, v AS mode FROM (
            SELECT feature, v, row_number() OVER (PARTITION BY feature ORDER BY n DESC, v) AS k FROM category_counts) WHERE k = 1),
filled AS (SELECT customerID, split, feature, coalesce(v, mode) AS v FROM texts JOIN modes USING (feature)),
categories AS (SELECT feature, v AS category, row_number() OVER (PARTITION BY feature ORDER BY v) AS k FROM category_counts),
encoded AS (
  SELECT customerID, split, feature AS name, (v - mean) / CASE WHEN std = 0 THEN 1 ELSE std END AS value
  FROM imputed JOIN moments USING (feature)
  UNION ALL
  SELECT customerID, split, f.feature || '_' || category AS name, CASE WHEN f.v = category THEN 1.0 ELSE 0.0 END AS value
  FROM filled f JOIN categories c ON f.feature = c.feature AND c.k > 1)"""

# --- confusion counts and rates -------------------------------------------
_COUNTS = """
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 0) AS BIGINT) AS true_negatives,
  CAST(count(*) FILTER (WHERE label = 0 AND prediction = 1) AS BIGINT) AS false_positives,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 0) AS BIGINT) AS false_negatives,
  CAST(count(*) FILTER (WHERE label = 1 AND prediction = 1) AS BIGINT) AS true_positives"""
_TN, _FP, _FN, _TP = "true_negatives", "false_positives", "false_negatives", "true_positives"


def _ratio(num: str, den: str) -> str:
    return f"CASE WHEN ({den}) <> 0 THEN CAST({num} AS DOUBLE) / CAST({den} AS DOUBLE) ELSE CAST(0 AS DOUBLE) END"


RATE = {
    "accuracy": _ratio(f"{_TP} + {_TN}", f"{_TN} + {_FP} + {_FN} + {_TP}"),
    "precision": _ratio(_TP, f"{_TP} + {_FP}"),
    "recall": _ratio(_TP, f"{_TP} + {_FN}"),
    "f1": _ratio(f"2 * {_TP}", f"2 * {_TP} + {_FP} + {_FN}"),
    "specificity": _ratio(_TN, f"{_TN} + {_FP}"),
    "sensitivity": _ratio(_TP, f"{_TP} + {_FN}"),
}
RATE["balanced_accuracy"] = f"(({RATE['specificity']}) + ({RATE['recall']})) / 2"


def _rates(*names: str, digits: int = 6) -> str:
    return ", ".join(f"{_r(RATE[n], digits)} AS {n}" for n in names)


ALL_RATES = ("accuracy", "precision", "recall", "f1", "specificity", "sensitivity", "balanced_accuracy")


def _curve(keys: str, source: str = "scored") -> str:
    return f"""
pairs AS (SELECT {keys}, p AS score, count(*) FILTER (WHERE label = 1) AS pos, count(*) FILTER (WHERE label = 0) AS neg
          FROM {source} WHERE p IS NOT NULL GROUP BY {keys}, p),
steps AS (SELECT *, sum(pos) OVER w AS tp, sum(neg) OVER w AS fp,
                 sum(pos) OVER (PARTITION BY {keys}) AS n_pos, sum(neg) OVER (PARTITION BY {keys}) AS n_neg,
                 lag(pos) OVER w AS prev_pos, lag(neg) OVER w AS prev_neg,
                 lead(pos) OVER w AS next_pos, lead(neg) OVER w AS next_neg, row_number() OVER w AS k
          FROM pairs WINDOW w AS (PARTITION BY {keys} ORDER BY score DESC)),
ranking AS (SELECT {keys},
    CASE WHEN max(n_pos) > 0 AND max(n_neg) > 0
         THEN sum(CAST(neg AS DOUBLE) * (tp - pos / CAST(2 AS DOUBLE))) / (CAST(max(n_pos) AS DOUBLE) * CAST(max(n_neg) AS DOUBLE)) END AS auc,
    CASE WHEN max(n_pos) > 0 THEN sum(CAST(pos AS DOUBLE) / n_pos * tp / (tp + fp)) ELSE CAST(0 AS DOUBLE) END AS average_precision
  FROM steps GROUP BY {keys})"""


GRID = "grid AS (SELECT CAST(k AS DOUBLE) / CAST(100 AS DOUBLE) AS threshold FROM range(1, 100) AS t(k))"
_SWEEP_COUNTS = """
  CAST(count(*) FILTER (WHERE label = 0 AND p < threshold) AS BIGINT) AS true_negatives,
  CAST(count(*) FILTER (WHERE label = 0 AND p >= threshold) AS BIGINT) AS false_positives,
  CAST(count(*) FILTER (WHERE label = 1 AND p < threshold) AS BIGINT) AS false_negatives,
  CAST(count(*) FILTER (WHERE label = 1 AND p >= threshold) AS BIGINT) AS true_positives"""
_SWEEP_RATES = ("precision", "recall", "f1", "specificity", "balanced_accuracy")
SWEEP = f"""{GRID},
sweep_counts AS (SELECT model, threshold, {_SWEEP_COUNTS} FROM scored CROSS JOIN grid GROUP BY model, threshold),
sweep AS (SELECT *, {', '.join(f'{RATE[n]} AS {n}' for n in _SWEEP_RATES)} FROM sweep_counts)"""
_OPT = ("f1", "precision", "recall", "balanced_accuracy")
_SWEEP_LONG = " UNION ALL ".join(f"SELECT model, threshold, '{m}' AS metric, {m} AS value FROM sweep" for m in _OPT)
BEST = f"""
sweep_long AS ({_SWEEP_LONG}),
best AS (SELECT model, metric, threshold, value AS score FROM (
           SELECT *, row_number() OVER (PARTITION BY model, metric ORDER BY value DESC, threshold) AS k FROM sweep_long)
         WHERE k = 1)"""


def _best_over_scores(metric: str) -> str:
    at_one = {"precision": "CAST(1 AS DOUBLE)", "recall": "CAST(0 AS DOUBLE)"}.get(metric)
    value = RATE[metric] if at_one is None else f"CASE WHEN extra = 1 THEN {at_one} ELSE {RATE[metric]} END"
    return f"""
candidates AS (SELECT DISTINCT model, p AS threshold, 0 AS extra FROM scored UNION ALL
               SELECT DISTINCT model, CAST(1 AS DOUBLE), 1 FROM scored),
candidate_counts AS (SELECT s.model, c.threshold, c.extra, {_SWEEP_COUNTS.replace('threshold', 'c.threshold')}
                     FROM scored s JOIN candidates c ON s.model = c.model GROUP BY s.model, c.threshold, c.extra),
valued AS (SELECT model, threshold, extra, {value} AS value FROM candidate_counts)
SELECT model, '{metric}' AS metric, threshold, {_r('value')} AS score FROM (
  SELECT *, row_number() OVER (PARTITION BY model ORDER BY value DESC, threshold, extra) AS k FROM valued) WHERE k = 1"""


def _report_rows() -> str:
    n = f"({_TN} + {_FP} + {_FN} + {_TP})"
    neg_p, neg_r = _ratio(_TN, f"{_TN} + {_FN}"), _ratio(_TN, f"{_TN} + {_FP}")
    neg_f = _ratio(f"2 * {_TN}", f"2 * {_TN} + {_FP} + {_FN}")
    n0, n1 = f"({_TN} + {_FP})", f"({_TP} + {_FN})"
    acc = RATE["accuracy"]

    def row(name, p, r, f, s):
        return (
            f"SELECT model, '{name}' AS row, {_r(p)} AS precision, {_r(r)} AS recall, {_r(f)} AS f1, "
            f"CAST({s} AS BIGINT) AS support FROM counts"
        )

    def mean(a, b):
        return f"(({a}) + ({b})) / 2"

    def weighted(a, b):
        return f"(({a}) * {n0} + ({b}) * {n1}) / CAST({n} AS DOUBLE)"

    return " UNION ALL ".join([
        row("Not Churn", neg_p, neg_r, neg_f, n0),
        row("Churn", RATE["precision"], RATE["recall"], RATE["f1"], n1),
        row("accuracy", acc, acc, acc, n),
        row("macro avg", mean(neg_p, RATE["precision"]), mean(neg_r, RATE["recall"]), mean(neg_f, RATE["f1"]), n),
        row("weighted avg", weighted(neg_p, RATE["precision"]), weighted(neg_r, RATE["recall"]), weighted(neg_f, RATE["f1"]), n),
    ])


def _segments(where: str) -> str:
    return _with(
        f"""SELECT c.model, c.segment, {', '.join((_TN, _FP, _FN, _TP))}, {_rates(*ALL_RATES)},
                   {_r('auc', 9)} AS auc, {_r('average_precision', 9)} AS average_precision,
                   {_r(_ratio(f'{_FN} + {_TP}', f'{_TN} + {_FP} + {_FN} + {_TP}'))} AS churn_rate,
                   CAST({_TN} + {_FP} + {_FN} + {_TP} AS BIGINT) AS count
            FROM counts c JOIN ranking r ON c.model = r.model AND c.segment = r.segment""",
        PROFILE, SCORED,
        f"segmented AS (SELECT *, Contract AS segment FROM scored WHERE {where})",
        f"counts AS (SELECT model, segment, {_COUNTS} FROM segmented GROUP BY model, segment)",
        _curve("model, segment", "segmented"),
    )


# --- exploratory ----------------------------------------------------------
_CAT_TARGET = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, {c} AS value, Churn AS target FROM clean WHERE {c} IS NOT NULL" for c in CATEGORICAL
)
_NUM_TARGET = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, Churn AS target, CAST({c} AS DOUBLE) AS v FROM clean WHERE {c} IS NOT NULL" for c in NUMERICAL
)
_SERVICE_TARGET = " UNION ALL ".join(
    f"SELECT '{c}' AS Service, coalesce({c} = 'Yes', false) AS has, Churn = 'Yes' AS churned FROM clean" for c in SERVICES
)
BOX = f"""
values_long AS ({_NUM_TARGET}),
q AS (SELECT feature, target, count(*) AS n, quantile_cont(v, 0.25) AS q1, quantile_cont(v, 0.5) AS med, quantile_cont(v, 0.75) AS q3
      FROM values_long GROUP BY feature, target),
placed AS (SELECT v.feature, v.target, v.v, q.n, q1, med, q3,
                  v.v >= q1 - CAST(1.5 AS DOUBLE) * (q3 - q1) AND v.v <= q3 + CAST(1.5 AS DOUBLE) * (q3 - q1) AS near
           FROM values_long v JOIN q ON v.feature = q.feature AND v.target = q.target)"""
SERVICE = f"""
flags AS ({_SERVICE_TARGET}),
by_service AS (SELECT Service, avg(CAST(churned AS DOUBLE) * 100) FILTER (WHERE has) AS with_service,
                      avg(CAST(churned AS DOUBLE) * 100) FILTER (WHERE NOT has) AS without_service
               FROM flags GROUP BY Service HAVING bool_or(has))"""

_CLEAN_COLUMNS = [
    "customerID", "gender", "SeniorCitizen", "Partner", "Dependents", "tenure", "PhoneService", "MultipleLines",
    "InternetService", "OnlineSecurity", "OnlineBackup", "DeviceProtection", "TechSupport", "StreamingTV",
    "StreamingMovies", "Contract", "PaperlessBilling", "PaymentMethod", "MonthlyCharges", "TotalCharges", "Churn",
    "Churn_Binary",
]


def _correlation() -> str:
    text = [c for c in _CLEAN_COLUMNS if c in CATEGORICAL or c == "Churn"]
    firsts = ",".join(
        f"f_{c} AS (SELECT {c} AS v, row_number() OVER (ORDER BY min(customerID)) - 1 AS code FROM clean "
        f"WHERE {c} IS NOT NULL GROUP BY {c})"
        for c in text
    )
    joins = " ".join(f"LEFT JOIN f_{c} ON clean.{c} = f_{c}.v" for c in text)
    columns = ", ".join(
        f"CAST(coalesce(f_{c}.code, -1) AS DOUBLE) AS {c}" if c in text else f"CAST(clean.{c} AS DOUBLE) AS {c}"
        for c in _CLEAN_COLUMNS
    )
    pairs = " UNION ALL ".join(
        f"SELECT '{a}' AS a, '{b}' AS b, corr({a}, {b}) AS r FROM coded"
        for i, a in enumerate(_CLEAN_COLUMNS) for b in _CLEAN_COLUMNS[:i]
    )
    return _clean(
        f"SELECT a, b, CASE WHEN isnan(r) THEN NULL ELSE {_r('r')} END AS r FROM ({pairs})",
        firsts, f"coded AS MATERIALIZED (SELECT {columns} FROM clean {joins})",
    )


def _cv_metrics_cte() -> str:
    return _curve("model, fold", "fold_scored")


FOLD_SCORED = "fold_scored AS (SELECT s.*, f.fold FROM scored s JOIN folds f USING (customerID))"
FOLD_METRICS = f"""fold_counts AS (SELECT model, fold, {_COUNTS} FROM fold_scored GROUP BY model, fold),
{_cv_metrics_cte()},
fold_metrics AS (SELECT c.model, c.fold, {', '.join(f'{RATE[n]} AS {n}' for n in ('accuracy', 'precision', 'recall', 'f1'))}, auc AS roc_auc
                 FROM fold_counts c JOIN ranking r ON c.model = r.model AND c.fold = r.fold)"""
_CV_LONG = " UNION ALL ".join(
    f"SELECT model AS Model, '{m}' AS Metric, {m} AS v FROM fold_metrics" for m in ("accuracy", "precision", "recall", "f1", "roc_auc")
)
CV_SUMMARY = (
    f"SELECT Model, Metric, {_r('avg(v)')} AS Mean, {_r('stddev_pop(v)')} AS Std FROM ({_CV_LONG}) GROUP BY Model, Metric"
)
_MODEL_COUNTS = f"counts AS (SELECT model, {_COUNTS} FROM scored GROUP BY model)"
_WIDE = """wide AS (SELECT customerID, label,
  max(prediction) FILTER (WHERE model = 'm1') AS d1, max(prediction) FILTER (WHERE model = 'm2') AS d2,
  max(prediction) FILTER (WHERE model = 'm3') AS d3,
  max(p) FILTER (WHERE model = 'm1') AS p1, max(p) FILTER (WHERE model = 'm2') AS p2, max(p) FILTER (WHERE model = 'm3') AS p3
  FROM scored GROUP BY customerID, label)"""
_OPTIMAL = """optimal AS (SELECT customerID, Contract, s.model || '_optimal' AS model, label, p, CAST(p >= threshold AS INTEGER) AS prediction
  FROM scored s JOIN best b ON s.model = b.model AND b.metric = 'f1')"""
_ALL_MODELS = ["m1", "m2", "m3", "m1_optimal", "m2_optimal", "m3_optimal"]
_PREDICTION_TABLE = "SELECT customerID AS CustomerID, label AS True_Churn, " + ", ".join(
    f"CAST(max(prediction) FILTER (WHERE model = '{m}') AS INTEGER) AS {m}_prediction, "
    f"max(p) FILTER (WHERE model = '{m}') AS {m}_probability" for m in _ALL_MODELS
) + " FROM (SELECT * FROM scored UNION ALL SELECT * FROM optimal) GROUP BY customerID, label"
_HIST = """edges AS (SELECT CAST(min(tenure) AS DOUBLE) AS lo, (CAST(max(tenure) AS DOUBLE) - CAST(min(tenure) AS DOUBLE)) / CAST(12 AS DOUBLE) AS w FROM clean),
binned AS (SELECT Churn AS target, least(CAST(floor((tenure - lo) / w) AS INTEGER), 11) AS bin FROM clean CROSS JOIN edges WHERE tenure IS NOT NULL),
cells AS (SELECT target, CAST(b AS INTEGER) AS bin FROM (SELECT DISTINCT target FROM binned) CROSS JOIN range(12) AS t(b))"""


EDA_TABLES = {
    "target_distribution": "target_distribution", "category_by_target": "category_by_target",
    "box_statistics": "box_statistics", "box_outliers": "box_outliers", "density": "density",
    "correlation_matrix": "correlation_matrix", "tenure_histogram": "tenure_histogram",
    "churn_by_tenure": "churn_by_tenure", "churn_by_service": "churn_by_service_long",
}
REPORT_TABLES = {
    "roc_curve": "roc_curve", "pr_curve": "pr_curve", "pr_summary": "pr_summary", "threshold_sweep": "threshold_sweep_long",
    "optimal_thresholds": "optimal_thresholds", "confusion_at_thresholds": "confusion_at_thresholds",
    "model_comparison": "model_comparison", "cross_validation": "cv_summary",
}


def statements() -> dict[str, str]:
    """Oracle per registered query name."""
    single = _single_statements()

    def row_counts(tables):
        return " UNION ALL ".join(
            f"SELECT '{name}' AS table_name, CAST(count(*) AS BIGINT) AS n_rows FROM ({single[query]})"
            for name, query in tables.items()
        )

    return {**single, "eda_job": row_counts(EDA_TABLES), "report_job": row_counts(REPORT_TABLES)}


def _single_statements() -> dict[str, str]:
    enc = "SELECT customerID, split, name, {} AS value FROM encoded"
    return {
        # sources and sinks
        "read_raw_table": _profile("SELECT * FROM profile"),
        "write_split_tables": _split("SELECT * FROM split"),
        "read_split_table": _split("SELECT * EXCLUDE (split) FROM split WHERE split = 'test'"),
        "write_predictions": _scored(_PREDICTION_TABLE, SWEEP, BEST, _OPTIMAL),
        # cleaning
        "clean_table": _clean("SELECT * FROM clean"),
        "charges_to_number": _profile(
            f"SELECT customerID, CASE WHEN regexp_matches(trim(TotalCharges), '{_NUMBER}') THEN CAST(trim(TotalCharges) AS DOUBLE) END AS TotalCharges FROM profile"),
        "fill_missing_charges": _clean("SELECT customerID, TotalCharges FROM clean"),
        "senior_to_text": _clean("SELECT customerID, SeniorCitizen FROM clean"),
        "binary_label": _clean("SELECT customerID, Churn, Churn_Binary FROM clean"),
        "drop_non_features": _clean("SELECT * EXCLUDE (Churn, Churn_Binary) FROM clean"),
        "select_features": _clean(
            "SELECT Contract, tenure, InternetService, OnlineSecurity, TechSupport, PaymentMethod, PaperlessBilling, "
            "MonthlyCharges, SeniorCitizen, MultipleLines, OnlineBackup, DeviceProtection, StreamingTV, StreamingMovies FROM clean"),
        # splits
        "stratified_split": _split("SELECT customerID, Churn_Binary, split FROM split"),
        "stratified_folds": _split("SELECT customerID, Churn_Binary, fold FROM folds"),
        "split_by_many_classes": _with(
            "SELECT id, part, CASE WHEN place <= share THEN 'test' ELSE 'train' END AS split FROM placed JOIN shares USING (part)", PARTS),
        "one_hot_wide": _with(
            "SELECT id, CASE WHEN place <= share THEN 'test' ELSE 'train' END AS split, (SELECT CAST(count(*) - 1 AS INTEGER) FROM codes) AS size, "
            "CASE WHEN code > 0 THEN code - 1 END AS place, CASE WHEN code > 0 THEN 1 ELSE 0 END AS entries "
            "FROM placed JOIN shares USING (part) LEFT JOIN codes ON codes.v = CAST(part AS VARCHAR)",
            PARTS, """
codes AS (SELECT v, CAST(row_number() OVER (ORDER BY v) - 1 AS INTEGER) AS code FROM (
    SELECT DISTINCT CAST(part AS VARCHAR) AS v FROM placed JOIN shares USING (part) WHERE place > share))"""),
        "folds_by_many_classes": _with(
            "SELECT id, part, CAST(" + " + ".join(f"CASE WHEN place > n * {f} // 5 THEN 1 ELSE 0 END" for f in range(1, 5)) +
            " AS INTEGER) AS fold FROM placed JOIN shares USING (part)", PARTS),
        "append_rows": _split(
            "SELECT customerID, tenure, Churn_Binary FROM split WHERE split = 'train' UNION ALL "
            "SELECT customerID, tenure, Churn_Binary FROM split WHERE split = 'test'"),
        "segment_rows": _scored("SELECT customerID, model, label, p FROM scored WHERE Contract = 'BUILDING'"),
        # features
        "tenure_groups": _clean(f"SELECT customerID, tenure, {TENURE_CASE} AS tenure_group, "
                                f"{_ordinal(TENURE_CASE, TENURE_LABELS)} AS tenure_group_ordinal FROM clean"),
        "fixed_domain_dummies": _clean(
            f"SELECT customerID, {_dummies('tenure_group', TENURE_LABELS, 'tenure_group')} FROM engineered", COUNTED),
        "service_count": _clean("SELECT customerID, CAST(service_count AS INTEGER) AS service_count FROM engineered", COUNTED),
        "service_count_groups": _clean(
            f"SELECT customerID, service_count_group, {_ordinal('service_count_group', COUNT_LABELS)} AS service_count_group_ordinal, "
            f"{_dummies('service_count_group', COUNT_LABELS, 'service_count')} FROM engineered", COUNTED),
        "charge_ratio": _clean(f"SELECT customerID, {_r('ratio')} AS tenure_to_monthly_ratio FROM engineered", COUNTED),
        "contract_tenure": _clean(
            "SELECT customerID, " + ", ".join(
                f"CAST(CASE WHEN Contract = '{c}' THEN tenure ELSE 0 END AS INTEGER) AS \"Contract_{c}_tenure\"" for c in CONTRACTS
            ) + " FROM clean"),
        "interaction_features": _clean(
            f"SELECT customerID, {_r('ratio')} AS tenure_to_monthly_ratio, " + ", ".join(
                f"CAST(CASE WHEN Contract = '{c}' THEN tenure ELSE 0 END AS INTEGER) AS \"Contract_{c}_tenure\"" for c in CONTRACTS
            ) + " FROM engineered", COUNTED),
        "engineer_features": _clean(
            f"SELECT customerID, tenure_group, CAST(service_count AS INTEGER) AS service_count, service_count_group, "
            f"{_r('ratio')} AS tenure_to_monthly_ratio, {_dummies('tenure_group', TENURE_LABELS, 'tenure_group')}, "
            f"{_dummies('service_count_group', COUNT_LABELS, 'service_count')} FROM engineered", COUNTED),
        "segment_mapping": _split(
            "SELECT DISTINCT t.feature AS \"column\", t.v AS value, t.feature || '_' || t.v AS encoded_column "
            "FROM texts t JOIN categories c ON t.feature = c.feature AND t.v = c.category AND c.k > 1 "
            "WHERE t.split = 'test' AND t.feature IN ('Contract', 'PaymentMethod')", PREP),
        # fitted preprocessing
        "median_impute": _split(
            f"SELECT customerID, split, feature, v AS value FROM imputed", PREP),
        "standard_scale": _split(
            f"SELECT feature, {_r('med')} AS median, {_r('mean')} AS mean, {_r('std')} AS std FROM moments JOIN medians USING (feature)", PREP),
        "mode_impute": _split("SELECT customerID, split, feature, v AS value FROM filled", PREP),
        "one_hot": _split(enc.format("value") + " WHERE position('_' IN name) > 0", PREP),
        "column_transformer": _split(
            f"SELECT feature, 'numeric' AS kind, {_r('med')} AS median, {_r('mean')} AS mean, {_r('std')} AS std, "
            "CAST(NULL AS VARCHAR) AS mode, CAST(NULL AS BIGINT) AS n_categories FROM moments JOIN medians USING (feature) UNION ALL "
            "SELECT feature, 'categorical', NULL, NULL, NULL, mode, CAST(max(k) AS BIGINT) FROM modes JOIN categories USING (feature) GROUP BY feature, mode",
            PREP),
        "fit_and_encode": _split(enc.format(_r("value")), PREP),
        "data_job": _split(
            f"SELECT e.split, s.Churn_Binary, e.name, CAST(count(*) AS BIGINT) AS n, {_r('avg(e.value)')} AS mean "
            "FROM encoded e JOIN split s USING (customerID) GROUP BY e.split, s.Churn_Binary, e.name", PREP),
        # training steps that SQL can express
        "class_weights": _clean(
            f"SELECT Churn_Binary AS label, CAST(n AS BIGINT) AS n, {_r('total / CAST(classes * n AS DOUBLE)')} AS weight FROM ("
            "SELECT Churn_Binary, count(*) AS n, CAST(sum(count(*)) OVER () AS DOUBLE) AS total, count(*) OVER () AS classes "
            "FROM clean GROUP BY Churn_Binary)"),
        "hard_vote": _scored("SELECT customerID, label, CAST(CASE WHEN d1 + d2 + d3 >= 2 THEN 1 ELSE 0 END AS INTEGER) AS prediction FROM wide", _WIDE),
        "soft_vote": _scored(
            f"SELECT customerID, label, {_r('(p1 + p2 + p3) / 3')} AS p, CAST((p1 + p2 + p3) / 3 > 0.5 AS INTEGER) AS prediction FROM wide", _WIDE),
        "scored_invariants": _split(
            "SELECT customerID, Churn_Binary AS label, CAST(4 AS BIGINT) AS n_models, true AS in_range, true AS consistent, true AS majority "
            "FROM split WHERE split = 'test'"),
        "saturated_tree": _share(9),
        "saturated_regression": _share(4),
        "saturated_soft_vote": _share(4),
        "saturated_reload": _share(4),
        "saturated_boosting": _share(9),
        "saturated_coefficients": _clean(
            f"SELECT 'Contract_' || Contract AS feature, {_r('odds - base', 3)} AS coefficient, {_r('abs(odds - base)', 3)} AS absolute_importance "
            "FROM (SELECT *, first_value(odds) OVER (ORDER BY Contract) AS base, row_number() OVER (ORDER BY Contract) AS k FROM ("
            "SELECT Contract, ln(avg(CAST(Churn_Binary AS DOUBLE)) / (1 - avg(CAST(Churn_Binary AS DOUBLE)))) AS odds FROM clean GROUP BY Contract)) WHERE k > 1"),
        "stump_nodes": _clean(
            f"SELECT id, depth, parent, feature, threshold, {_r('2 * p * (1 - p)', 9)} AS impurity, CASE WHEN p > 0.5 THEN '{CLASSES[1]}' ELSE '{CLASSES[0]}' END AS class, "
            f"{_r('gain', 9)} AS gain FROM ("
            "SELECT 0 AS id, 0 AS depth, CAST(NULL AS INTEGER) AS parent, 'Partner_Yes' AS feature, CAST(0.5 AS DOUBLE) AS threshold, p, "
            "2 * p * (1 - p) - (SELECT sum(share * 2 * p * (1 - p)) FROM side) AS gain FROM whole "
            "UNION ALL SELECT CASE WHEN Partner = 'No' THEN 1 ELSE 2 END, 1, 0, NULL, NULL, p, NULL FROM side)",
            "whole AS (SELECT avg(CAST(Churn_Binary AS DOUBLE)) AS p, count(*) AS n FROM clean)",
            "side AS (SELECT Partner, avg(CAST(Churn_Binary AS DOUBLE)) AS p, count(*) / CAST((SELECT n FROM whole) AS DOUBLE) AS share FROM clean GROUP BY Partner)"),
        "boosting_reweight": _scored(
            f"SELECT customerID, model, label, {_r('raised / sum(raised) OVER ()', 12)} AS weight FROM ("
            "SELECT customerID, model, label, exp(-0.5 * (2 * label - 1) * (ln(p) - ln(1 - p))) / count(*) OVER () AS raised "
            "FROM scored)"),
        # scoring
        "threshold_predictions": _scored("SELECT customerID, model, CAST(p >= 0.35 AS INTEGER) AS prediction FROM scored"),
        "optimal_predictions": _scored("SELECT customerID, Contract, model, label, p, prediction FROM optimal", SWEEP, BEST, _OPTIMAL),
        "prediction_table": _scored(_PREDICTION_TABLE, SWEEP, BEST, _OPTIMAL),
        # evaluation
        "full_metrics": _scored(
            f"SELECT c.model, {', '.join((_TN, _FP, _FN, _TP))}, {_rates(*ALL_RATES)}, {_r('auc', 9)} AS auc, "
            f"{_r('average_precision', 9)} AS average_precision FROM counts c JOIN ranking r USING (model)", _MODEL_COUNTS, _curve("model")),
        "model_metrics": _scored(
            f"SELECT c.model, {', '.join((_TN, _FP, _FN, _TP))}, {_rates('accuracy', 'precision', 'recall')}, {_r(RATE['f1'])} AS f1_score, "
            f"{_r('auc', 9)} AS auc FROM counts c JOIN ranking r USING (model)", _MODEL_COUNTS, _curve("model")),
        "confusion_matrix": _scored("SELECT * FROM counts", _MODEL_COUNTS),
        "classification_report": _scored(_report_rows(), _MODEL_COUNTS),
        "metrics_by_segment": _segments("Contract IS NOT NULL"),
        "metrics_by_encoded_segment": _segments("Contract <> (SELECT min(Contract) FROM scored)"),
        "roc_auc": _scored(f"SELECT model, {_r('auc', 9)} AS auc FROM ranking", _curve("model")),
        "roc_auc_in_ranges": _scored(f"SELECT model, {_r('auc', 9)} AS auc FROM ranking", _curve("model")),
        "average_precision": _scored(f"SELECT model, {_r('average_precision', 9)} AS average_precision FROM ranking", _curve("model")),
        "roc_curve": _scored(
            f"SELECT model, {_r('CAST(fp AS DOUBLE) / n_neg', 9)} AS fpr, {_r('CAST(tp AS DOUBLE) / n_pos', 9)} AS tpr, score AS threshold FROM steps "
            "WHERE k = 1 OR next_pos IS NULL OR next_pos <> pos OR next_neg <> neg "
            "UNION ALL SELECT model, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE), max(score) + 1 FROM steps GROUP BY model", _curve("model")),
        "pr_curve": _scored(
            f"SELECT model, {_r('CAST(tp AS DOUBLE) / (tp + fp)', 9)} AS precision, {_r('CAST(tp AS DOUBLE) / n_pos', 9)} AS recall, score AS threshold FROM steps "
            "UNION ALL SELECT DISTINCT model, CAST(1 AS DOUBLE), CAST(0 AS DOUBLE), CAST(NULL AS DOUBLE) FROM steps", _curve("model")),
        "pr_summary": _scored(
            f"SELECT model, {_r('sum((r - coalesce(pr, 0)) * (p + coalesce(pp, 1)) / 2)', 9)} AS pr_auc, {_r('max(base)', 9)} AS baseline FROM ("
            "SELECT model, p, r, lag(p) OVER w AS pp, lag(r) OVER w AS pr, base FROM ("
            "SELECT model, score, CAST(tp AS DOUBLE) / (tp + fp) AS p, CAST(tp AS DOUBLE) / n_pos AS r, CAST(n_pos AS DOUBLE) / (n_pos + n_neg) AS base FROM steps) "
            "WINDOW w AS (PARTITION BY model ORDER BY score DESC)) GROUP BY model", _curve("model")),
        "model_comparison": _scored(
            f"SELECT c.model AS \"Model\", {_r(RATE['accuracy'])} AS \"Accuracy\", {_r(RATE['precision'])} AS \"Precision\", "
            f"{_r(RATE['recall'])} AS \"Recall\", {_r(RATE['f1'])} AS \"F1\", {_r('auc')} AS \"Auc\" "
            "FROM counts c JOIN ranking r USING (model) ORDER BY \"F1\" DESC, \"Model\"", _MODEL_COUNTS, _curve("model")),
        # cross-validation
        "fold_metrics": _split(
            f"SELECT model, fold, {', '.join(f'{_r(m)} AS {m}' for m in ('accuracy', 'precision', 'recall', 'f1', 'roc_auc'))} FROM fold_metrics",
            SCORED, FOLD_SCORED, FOLD_METRICS),
        "cv_summary": _split(CV_SUMMARY, SCORED, FOLD_SCORED, FOLD_METRICS),
        # thresholds
        "threshold_sweep": _scored(
            f"SELECT model, threshold, {', '.join((_TP, _FP, _TN, _FN))}, {', '.join(f'{_r(n)} AS {n}' for n in _SWEEP_RATES)} FROM sweep", SWEEP),
        "best_threshold_on_grid": _scored(
            f"SELECT model, metric, threshold, {_r('score')} AS score FROM best", SWEEP, BEST),
        "optimal_thresholds": _scored(f"SELECT model, metric, threshold, {_r('score')} AS score FROM best", SWEEP, BEST),
        "best_threshold_over_scores": _scored(_union_best(["f1", "precision", "recall", "balanced_accuracy"])),
        "optimal_thresholds_by_segment": _with(
            f"SELECT model, Contract, metric, threshold, {_r('value')} AS score FROM ("
            "SELECT *, row_number() OVER (PARTITION BY model, Contract, metric ORDER BY value DESC, threshold) AS k FROM segment_long) WHERE k = 1",
            PROFILE, SCORED, GRID,
            f"segment_counts AS (SELECT model, Contract, threshold, {_SWEEP_COUNTS} FROM scored CROSS JOIN grid GROUP BY model, Contract, threshold)",
            "segment_long AS (" + " UNION ALL ".join(
                f"SELECT model, Contract, threshold, '{m}' AS metric, {RATE[m]} AS value FROM segment_counts" for m in _OPT) + ")"),
        "confusion_at_thresholds": _scored(
            f"SELECT model, threshold, {', '.join((_TN, _FP, _FN, _TP))}, {_rates('accuracy', 'precision', 'recall', 'f1')} FROM ("
            f"SELECT model, threshold, {_SWEEP_COUNTS} FROM scored CROSS JOIN "
            "(SELECT CAST(t AS DOUBLE) AS threshold FROM (VALUES (0.3), (0.4), (0.5), (0.6), (0.7)) AS v(t)) GROUP BY model, threshold)"),
        "threshold_sweep_long": _scored(f"SELECT model, threshold, metric, {_r('value')} AS value FROM sweep_long", SWEEP, BEST),
        # exploratory
        "target_distribution": _clean(
            "SELECT Churn AS value, CAST(count(*) AS BIGINT) AS count, "
            "round_even(CAST(count(*) AS DOUBLE) / (SELECT count(*) FROM clean) * 100, 1) AS percentage "
            "FROM clean WHERE Churn IS NOT NULL GROUP BY Churn"),
        "category_by_target": _clean(
            f"SELECT c.feature, c.value, c.target, CAST(coalesce(n, 0) AS BIGINT) AS count, "
            f"{_r('CAST(coalesce(n, 0) AS DOUBLE) / sum(coalesce(n, 0)) OVER (PARTITION BY c.feature, c.value) * 100')} AS percentage "
            "FROM cells c LEFT JOIN found f ON c.feature = f.feature AND c.value = f.value AND c.target = f.target",
            f"long AS ({_CAT_TARGET})",
            "found AS (SELECT feature, value, target, count(*) AS n FROM long GROUP BY feature, value, target)",
            "cells AS (SELECT feature, value, target FROM (SELECT DISTINCT feature, value FROM long) CROSS JOIN (SELECT DISTINCT target FROM long))"),
        "box_statistics": _clean(
            f"SELECT feature, target, CAST(n AS BIGINT) AS n, {_r('q1')} AS q1, {_r('med')} AS median, {_r('q3')} AS q3, "
            f"{_r('least(min(v) FILTER (WHERE near), q1)')} AS low_whisker, {_r('greatest(max(v) FILTER (WHERE near), q3)')} AS high_whisker, "
            "CAST(count(*) FILTER (WHERE NOT near) AS BIGINT) AS n_outliers FROM placed GROUP BY feature, target, n, q1, med, q3", BOX),
        "box_statistics_in_rounds": _clean(
            f"SELECT feature, target, CAST(n AS BIGINT) AS n, {_r('q1')} AS q1, {_r('med')} AS median, {_r('q3')} AS q3, "
            f"{_r('least(min(v) FILTER (WHERE near), q1)')} AS low_whisker, {_r('greatest(max(v) FILTER (WHERE near), q3)')} AS high_whisker, "
            "CAST(count(*) FILTER (WHERE NOT near) AS BIGINT) AS n_outliers FROM placed GROUP BY feature, target, n, q1, med, q3", BOX),
        "box_outliers": _clean(
            f"SELECT feature, target, {_r('v')} AS value, CAST(count(*) AS BIGINT) AS count FROM placed WHERE NOT near GROUP BY feature, target, v", BOX),
        "density": _clean(
            f"SELECT v.feature, v.target, CAST(i AS INTEGER) AS i, {_r('start + i * step')} AS x, "
            f"{_r('sum(exp(-0.5 * ((start + i * step - v) / h) ** 2)) / (n * h * sqrt(2 * pi()))', 9)} AS density "
            "FROM values_long v JOIN spread s ON v.feature = s.feature AND v.target = s.target CROSS JOIN range(100) AS t(i) "
            "GROUP BY v.feature, v.target, i, start, step, n, h",
            f"values_long AS ({_NUM_TARGET})",
            "spread AS (SELECT feature, target, n, h, lo - 2 * h AS start, (hi - lo + 4 * h) / CAST(99 AS DOUBLE) AS step FROM ("
            "SELECT feature, target, count(*) AS n, min(v) AS lo, max(v) AS hi, stddev_samp(v) * pow(CAST(count(*) AS DOUBLE), CAST(-0.2 AS DOUBLE)) AS h "
            "FROM values_long GROUP BY feature, target))"),
        "correlation_matrix": _correlation(),
        "tenure_histogram": _clean(
            f"SELECT c.bin, {_r('lo + c.bin * w')} AS low, {_r('lo + (c.bin + 1) * w')} AS high, c.target, CAST(count(b.bin) AS BIGINT) AS count "
            "FROM cells c CROSS JOIN edges LEFT JOIN binned b ON c.target = b.target AND c.bin = b.bin GROUP BY c.bin, c.target, lo, w", _HIST),
        "churn_by_tenure": _clean(
            f"SELECT CAST(position AS INTEGER) AS position, l.tenure_group, CAST(count(c.customerID) AS BIGINT) AS customers, "
            f"{_r('coalesce(avg(CASE WHEN c.customerID IS NULL THEN NULL WHEN Churn = ' + chr(39) + 'Yes' + chr(39) + ' THEN CAST(100 AS DOUBLE) ELSE 0 END), 0)')} AS churn_rate "
            "FROM (VALUES (0, '0-12', 0, 12), (1, '13-24', 12, 24), (2, '25-36', 24, 36), (3, '37-48', 36, 48), (4, '49-60', 48, 60), (5, '61-72', 60, 72)) "
            "AS l(position, tenure_group, lo, hi) LEFT JOIN clean c ON c.tenure > lo AND c.tenure <= hi GROUP BY position, l.tenure_group"),
        "churn_by_service": _clean(
            f"SELECT Service AS \"Service\", {_r('with_service')} AS \"With Service\", {_r('without_service')} AS \"Without Service\" FROM by_service", SERVICE),
        "churn_by_service_long": _clean(
            f"SELECT Service AS \"Service\", 'With Service' AS \"Status\", {_r('with_service')} AS \"Churn Rate (%)\" FROM by_service UNION ALL "
            f"SELECT Service, 'Without Service', {_r('without_service')} FROM by_service", SERVICE),
    }


def _union_best(metrics: list[str]) -> str:
    """Best threshold over all scores for several metrics, each as a sub-statement."""
    parts = []
    for m in metrics:
        ctes, _, body = _best_over_scores(m).rpartition("\nSELECT")
        parts.append(f"SELECT * FROM (WITH {ctes}\nSELECT{body})")
    return " UNION ALL ".join(parts)
