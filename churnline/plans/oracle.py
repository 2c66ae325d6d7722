"""SQL that computes the registered queries from the given tables in another engine."""

from __future__ import annotations

from churnline.plans.oracle_panel import FEATURES, FEATURES_CTE, LEVELS, RAW, column_name, one_hot_names
from churnline.plans.queries import GATE_MIN_ROWS, SCENARIOS, SMALL_GAP, WANTED_LEVELS
from churnline.plans.stages import CARD, CARD_THRESHOLD
from churnline.schema import INTERNET_ADD_ONS

SEGMENT_FLAGS = [
    "Contract_ord", "is_high_value", "IS_DSL", "IS_Fiber_optic", "IS_No",
    *sorted(n for n in one_hot_names() if n.startswith("PM_")),
]


def _yes(column: str) -> str:
    return f"CASE WHEN lower(trim({column})) = 'yes' THEN 1 ELSE 0 END"


def _logit(values: dict[str, str] | None = None) -> str:
    values = values or {}
    terms = [f"CAST({w} AS DOUBLE) * {values.get(c, c)}" for c, w in CARD.weights.items()]
    return " + ".join([f"CAST({CARD.intercept} AS DOUBLE)", *terms])


def _score(values: dict[str, str] | None = None) -> str:
    return f"round(1 / (1 + exp(-({_logit(values)}))), 6)"


MODELLING = f"""{FEATURES_CTE.rstrip()},
ordered AS (
  SELECT *, row_number() OVER (ORDER BY tenure, md5(customerID), customerID) AS place, count(*) OVER () AS total
  FROM features),
modelling AS (
  SELECT * EXCLUDE (place, total), CASE WHEN place <= floor(total * 0.8) THEN 'train' ELSE 'test' END AS split FROM ordered),
scored AS (SELECT *, {_score()} AS score FROM modelling),
test AS (SELECT customerID, Churn, score FROM scored WHERE split = 'test'),
points AS (
  SELECT score, n, pos, sum(n) OVER w AS cum_n, sum(pos) OVER w AS cum_pos, sum(pos) OVER () AS all_pos
  FROM (SELECT score, count(*) AS n, sum(Churn) AS pos FROM test GROUP BY score) WINDOW w AS (ORDER BY score DESC)),
f1s AS (
  SELECT score, cum_pos / cum_n AS p, cum_pos / all_pos AS r,
         2 * (cum_pos / cum_n) * (cum_pos / all_pos) / greatest(cum_pos / cum_n + cum_pos / all_pos, 1e-9) AS f1
  FROM points),
best AS (SELECT score AS threshold, f1 FROM f1s ORDER BY f1 DESC, score LIMIT 1),
ranked AS (
  SELECT *, row_number() OVER r AS place, sum(Churn) OVER (r ROWS UNBOUNDED PRECEDING) AS captured,
         count(*) OVER () AS n, sum(Churn) OVER () AS pos
  FROM test WINDOW r AS (ORDER BY score DESC, md5(customerID), customerID)),
top AS (
  SELECT place AS k, CAST(captured AS BIGINT) AS captured, captured / greatest(pos, 1) AS recall,
         (captured / place) / (pos / n) AS lift
  FROM ranked WHERE place = greatest(1, ceil(n * 0.1)))
"""

AVERAGE_PRECISION = "(SELECT sum(pos / all_pos * (cum_pos / cum_n)) FROM points)"
ROC_AUC = """(SELECT (sum(CASE WHEN Churn = 1 THEN mean_rank END) - sum(Churn) * (sum(Churn) + 1) / 2)
         / (CAST(sum(Churn) AS DOUBLE) * (count(*) - sum(Churn)))
  FROM (SELECT Churn, rank() OVER (ORDER BY score) + (count(*) OVER (PARTITION BY score) - 1) / 2 AS mean_rank FROM test))"""
METRICS = f"""metrics(metric, value) AS (
  SELECT 'pr_auc', round({AVERAGE_PRECISION}, 6) UNION ALL SELECT 'roc_auc', round({ROC_AUC}, 6)
  UNION ALL SELECT 'recall_top10', round(recall, 6) FROM top UNION ALL SELECT 'lift_top10', round(lift, 6) FROM top
  UNION ALL SELECT 'threshold', threshold FROM best UNION ALL SELECT 'f1', round(f1, 6) FROM best)"""

LONG = f"""{FEATURES_CTE.rstrip()},
doubles AS (SELECT customerID, Churn, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in FEATURES)} FROM features),
long AS (UNPIVOT doubles ON {", ".join(FEATURES)} INTO NAME feature VALUE value),
splits AS (
  SELECT feature, min(value) AS min_value, max(value) AS max_value, quantile_cont(value, 0.5) AS median,
         CASE WHEN quantile_cont(value, 0.5) IN (min(value), max(value)) THEN avg(value)
              ELSE quantile_cont(value, 0.5) END AS split_value,
         CASE WHEN quantile_cont(value, 0.5) IN (min(value), max(value)) THEN 'mean' ELSE 'median' END AS split_kind
  FROM long GROUP BY feature HAVING count(DISTINCT value) >= 2),
weights(feature, weight) AS (VALUES {", ".join(f"('{c}', CAST({w} AS DOUBLE))" for c, w in CARD.weights.items())}),
contributions AS (
  SELECT customerID, l.feature, value, weight * (value - mean) AS contribution
  FROM long l JOIN weights USING (feature) JOIN (SELECT feature, avg(value) AS mean FROM long GROUP BY feature) USING (feature)),
importance AS (
  SELECT f.feature, coalesce(round(avg(abs(contribution)), 6), 0.0) AS mean_abs
  FROM (SELECT DISTINCT feature FROM long) f LEFT JOIN contributions c ON c.feature = f.feature GROUP BY f.feature),
halves AS (
  SELECT feature, split_value, split_kind, count(*) FILTER (value > split_value) AS n_high,
         count(*) FILTER (value <= split_value) AS n_low,
         avg(Churn) FILTER (value > split_value) AS high_rate, avg(Churn) FILTER (value <= split_value) AS low_rate,
         avg(Churn) AS baseline_rate
  FROM long JOIN splits USING (feature) GROUP BY feature, split_value, split_kind)
"""


def _candidates(gap: float) -> str:
    return f"""candidates AS (
  SELECT h.*, CASE WHEN low_rate > 0 THEN high_rate / low_rate END AS ratio, mean_abs,
    CASE WHEN n_high >= 50 AND n_low >= 50 AND low_rate > 0 AND abs(high_rate - low_rate) >= {gap} THEN 1 ELSE 0 END AS qualifies
  FROM halves h JOIN importance USING (feature)),
segments AS (
  SELECT CAST(row_number() OVER (ORDER BY mean_abs DESC, feature) AS INTEGER) AS rank, * EXCLUDE (qualifies)
  FROM candidates WHERE qualifies = 1 ORDER BY rank LIMIT 3),
report AS (
  SELECT rank, feature, CASE WHEN high_rate > low_rate THEN 'above' ELSE 'below' END AS direction, split_value, split_kind,
    greatest(high_rate, low_rate) AS risky_rate, least(high_rate, low_rate) AS other_half_rate,
    CASE WHEN high_rate > low_rate THEN ratio WHEN high_rate > 0 THEN low_rate / high_rate END AS ratio,
    CASE WHEN high_rate > low_rate THEN n_high ELSE n_low END AS affected, mean_abs, baseline_rate
  FROM segments)"""


def _round(*columns: str) -> str:
    return ", ".join(f"round({c}, 6) AS {c}" for c in columns)


_SEGMENT = "feature, split_kind, n_high, n_low, " + _round("split_value", "high_rate", "low_rate", "ratio", "mean_abs", "baseline_rate")
_REPORT = "rank, feature, direction, split_kind, affected, " + _round(
    "split_value", "risky_rate", "other_half_rate", "ratio", "mean_abs", "baseline_rate"
)


def _segment_churn(column: str) -> str:
    return f"""{FEATURES_CTE} SELECT CAST({column} AS VARCHAR) AS level, round(avg(Churn), 6) AS churn_rate, count(*) AS n
FROM named GROUP BY {column}"""


def _stack(parts: list[str]) -> str:
    return "\nUNION ALL ".join(parts)


def _segments_of(table: str, columns: list[str]) -> str:
    return _stack(
        f"SELECT '{c}' AS segment, CAST({c} AS VARCHAR) AS level, round(avg(Churn), 6) AS churn_rate, count(*) AS n FROM {table} GROUP BY {c}"
        for c in columns
    )


def _target_corr(columns: list[str], table: str = "features") -> str:
    wide = ", ".join(
        f"CASE WHEN stddev_pop({c}) > 0 THEN round(covar_pop({c}, Churn) / (stddev_pop({c}) * stddev_pop(Churn)), 6) END AS {c}"
        for c in columns
    )
    return f"""wide AS (SELECT {wide} FROM {table}),
target_corr AS (
  SELECT feature, corr, CAST(row_number() OVER (ORDER BY abs(corr) DESC NULLS LAST, feature) AS INTEGER) AS rank
  FROM wide UNPIVOT INCLUDE NULLS (corr FOR feature IN ({", ".join(columns)})))"""


_PAIRS = f"""both_long AS (UNPIVOT (SELECT customerID, {", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in [*FEATURES, "Churn"])} FROM features)
  ON {", ".join([*FEATURES, "Churn"])} INTO NAME feature VALUE value)"""


def _pairs(where: str = "") -> str:
    return f"""SELECT a.feature AS feature_a, b.feature AS feature_b,
  CASE WHEN stddev_pop(a.value) * stddev_pop(b.value) > 0 THEN round(corr(a.value, b.value), 6) END AS corr
FROM both_long a JOIN both_long b USING (customerID) {where} GROUP BY ALL"""


_DRIVERS = """drivers AS (
  SELECT * FROM (
    SELECT direction, CAST(row_number() OVER (PARTITION BY direction ORDER BY rank) AS INTEGER) AS place, feature, corr
    FROM (SELECT *, CASE WHEN corr > 0 THEN 'positive' ELSE 'negative' END AS direction FROM target_corr WHERE corr <> 0))
  WHERE place <= 5)"""

_DRIVER_TEXT = """drivers AS (
  SELECT customerID, string_agg(printf('%s(%+.2f)', feature, contribution), ', ' ORDER BY place) AS drivers
  FROM (SELECT *, row_number() OVER (PARTITION BY customerID ORDER BY abs(contribution) DESC, feature) AS place FROM contributions)
  WHERE place <= 3 GROUP BY customerID)"""

# Every feature's contribution; those without a weight contribute nothing.
_WHOLE = """whole AS MATERIALIZED (
  SELECT customerID, l.feature, value, CASE WHEN weight IS NULL THEN 0.0::DOUBLE ELSE weight * (value - mean) END AS contribution
  FROM long l LEFT JOIN weights USING (feature) JOIN (SELECT feature, avg(value) AS mean FROM long GROUP BY feature) USING (feature))
"""

_TIER = """CASE WHEN score <= 0 OR score > 1 THEN NULL WHEN score <= 0.3 THEN 'Low' WHEN score <= 0.5 THEN 'Medium'
  WHEN score <= 0.7 THEN 'High' ELSE 'Critical' END"""

_REVENUE = """revenue AS (
  SELECT count(*) AS customers, CAST(sum(Churn) AS BIGINT) AS churners, round(avg(Churn), 6) AS churn_rate,
    round(churner_monthly, 6) AS churner_monthly, test_size, k AS contacts,
    CAST(greatest(1, round_even(test_size * 0.1, 0)) AS BIGINT) AS contacts_rounded, captured,
    round(captured * 0.3 * (churner_monthly * 12), 2) AS revenue_kept
  FROM features,
    (SELECT CAST(sum(CAST(MonthlyCharges AS DECIMAL(18,2))) AS DOUBLE) / count(*) AS churner_monthly FROM features WHERE Churn = 1),
    (SELECT count(*) AS test_size FROM test), top
  GROUP BY churner_monthly, test_size, k, captured)"""


def _whatif() -> str:
    scenarios: dict[str, dict[str, float]] = {}
    for name, feature, value in SCENARIOS:
        scenarios.setdefault(name, {})[feature] = value
    parts = []
    for name, changes in scenarios.items():
        values = {c: f"CAST({v} AS DOUBLE)" for c, v in changes.items()}
        moved = ", ".join(
            f"CASE WHEN abs({values[c]} - {c}) > 1e-6 THEN '{c}' END" if c in values else "NULL" for c in CARD.weights
        )
        parts.append(
            f"SELECT customerID, '{name}' AS scenario, {_score()} AS base_score, {_score(values)} AS new_score, "
            f"concat_ws(', ', {moved}) AS changed FROM features"
        )
    return f"""{FEATURES_CTE.rstrip()},
rescored AS ({_stack(parts)}),
compared AS (SELECT *, round(new_score - base_score, 6) AS delta FROM rescored)
SELECT *, CASE WHEN abs(delta) < 0.01 THEN 'unchanged' WHEN delta < 0 THEN 'reduced' ELSE 'increased' END AS direction FROM compared"""


def oracle_sql() -> dict[str, str]:
    encoded = lambda *columns: ", ".join(
        column_name(f"{p}_{level}") for c, p in columns for level in LEVELS[c]
    )
    numbers = ["avg_monthly_charges", "charges_per_service", "TotalCharges", "MonthlyCharges"]
    feature_list = ", ".join(f"round({c}, 6) AS {c}" if c in numbers else c for c in FEATURES)
    scaled = ", ".join(
        f"round(({c} - avg({c}) FILTER (split = 'train') OVER ()) / coalesce(nullif(stddev_pop({c}) FILTER (split = 'train') OVER (), 0), 1), 6) AS {c}"
        for c in FEATURES
    )
    corr = _target_corr(FEATURES)
    levels = ", ".join(f"('{a}', '{b}')" for a, b in WANTED_LEVELS)
    ranges = _stack(
        f"SELECT '{c}' AS feature, round(min({c})::DOUBLE, 6) AS min_value, round(max({c})::DOUBLE, 6) AS max_value, "
        f"greatest(0.01::DOUBLE, round((max({c})::DOUBLE - min({c})::DOUBLE) / 100, 4)) AS step FROM features"
        for c in FEATURES
    )
    manifest = {
        "raw_customers": "raw", "features": "features", "cohort_churn": "(SELECT DISTINCT tenure_bucket FROM named)",
        "segment_churn": "(" + _segments_of("named", ["Contract", "PaymentMethod", "InternetService", "is_high_value"]) + ")",
        "class_balance": "(SELECT DISTINCT Churn FROM features)",
        "target_correlation": "(SELECT DISTINCT feature FROM both_long WHERE feature <> 'Churn')",
        "scores": "scored", "gains_curve": "(SELECT DISTINCT ceil(p * n / 100) FROM range(1, 101) t(p), (SELECT count(*) AS n FROM test))",
        "evaluation_metrics": "metrics", "attributions": "features",
        "global_importance": "(SELECT DISTINCT feature FROM both_long WHERE feature <> 'Churn')",
        "risk_tiers": "(VALUES ('Low'), ('Medium'), ('High'), ('Critical'))",
    }
    return {
        "raw_customers": f"{RAW} SELECT * FROM raw",
        "features_table_count": f"{FEATURES_CTE} SELECT count(*) AS n_rows FROM features",
        "features_catalog_count": f"{FEATURES_CTE} SELECT count(*) AS n_rows FROM features",
        "output_manifest": f"{MODELLING.rstrip()},\n{METRICS},\n{_PAIRS}\n"
        + _stack(
            f"SELECT '{name}' AS table_name, count(*) AS n_rows, CASE WHEN count(*) > 0 THEN 1 ELSE 0 END AS ok FROM {source}"
            for name, source in manifest.items()
        ),
        "clean_charges": f"{FEATURES_CTE} SELECT customerID, TotalCharges, Churn FROM named",
        "engineered_features": f"{FEATURES_CTE} SELECT customerID, {_round('avg_monthly_charges', 'charges_per_service')}, active_services, is_high_value FROM features",
        "tenure_bucket": f"{FEATURES_CTE} SELECT customerID, tenure, tenure_bucket FROM named",
        "contract_ordinal": f"{FEATURES_CTE} SELECT customerID, Contract, Contract_ord FROM features JOIN raw USING (customerID)",
        "unseen_contracts": f"{RAW} SELECT Contract AS level, count(*) AS n FROM raw WHERE Contract IS NULL OR Contract NOT IN ('Month-to-month', 'One year', 'Two year') GROUP BY Contract",
        "unseen_payments": f"{RAW} SELECT PaymentMethod AS level, count(*) AS n FROM raw WHERE PaymentMethod IS NULL OR PaymentMethod NOT IN ('Electronic check', 'Mailed check', 'Bank transfer (automatic)', 'Credit card (automatic)') GROUP BY PaymentMethod",
        "onehot_internet_payment": f"{FEATURES_CTE} SELECT customerID, {encoded(('InternetService', 'IS'), ('PaymentMethod', 'PM'))} FROM features",
        "binary_encodings": f"{FEATURES_CTE} SELECT customerID, gender, Partner, Dependents, PhoneService, PaperlessBilling FROM features",
        "onehot_services": f"{FEATURES_CTE} SELECT customerID, {encoded(*[(c, c) for c in ['MultipleLines', *INTERNET_ADD_ONS]])} FROM features",
        "onehot_tenure": f"{FEATURES_CTE} SELECT customerID, tb_0_12, tb_13_24, tb_25_48, tb_49_ FROM features",
        "feature_table": f"{FEATURES_CTE} SELECT customerID, Churn, {feature_list} FROM features",
        "segment_column_levels": f"{FEATURES_CTE} "
        + _stack(
            f"SELECT {i} AS position, '{c}' AS column_name, count(DISTINCT {c}) AS levels FROM features"
            for i, c in enumerate(SEGMENT_FLAGS, 1)
        ).replace("SELECT 1 AS", "SELECT 1::BIGINT AS", 1),
        "quality_nulls": f"{FEATURES_CTE} "
        + _stack(
            f"SELECT '{c}' AS column_name, count(*) - count({c}) AS nulls FROM features"
            for c in ["tenure", "MonthlyCharges", "TotalCharges", "Churn"]
        ),
        "quality_gate": f"""{FEATURES_CTE.rstrip()},
facts AS (SELECT CAST(count(*) FILTER (tenure IS NULL) + count(*) FILTER (MonthlyCharges IS NULL) + count(*) FILTER (TotalCharges IS NULL)
    + count(*) FILTER (Churn IS NULL) AS DOUBLE) AS nulls, CAST(count(*) AS DOUBLE) AS n, avg(Churn) AS rate FROM features)
SELECT 'key_nulls' AS "check", nulls AS value, CASE WHEN nulls = 0 THEN 1 ELSE 0 END AS ok FROM facts
UNION ALL SELECT 'row_count', n, CASE WHEN n > {GATE_MIN_ROWS} THEN 1 ELSE 0 END FROM facts
UNION ALL SELECT 'churn_rate', round(rate, 6), CASE WHEN rate > 0.1 AND rate < 0.4 THEN 1 ELSE 0 END FROM facts""",
        "observed_quality_gate": f"""{FEATURES_CTE.rstrip()},
facts AS (SELECT CAST(count(*) FILTER (tenure IS NULL) + count(*) FILTER (MonthlyCharges IS NULL) + count(*) FILTER (TotalCharges IS NULL)
    + count(*) FILTER (Churn IS NULL) AS DOUBLE) AS nulls, CAST(count(*) AS DOUBLE) AS n, avg(Churn) AS rate FROM features)
SELECT 'key_nulls' AS "check", nulls AS value, CASE WHEN nulls = 0 THEN 1 ELSE 0 END AS ok FROM facts
UNION ALL SELECT 'row_count', n, CASE WHEN n > {GATE_MIN_ROWS} THEN 1 ELSE 0 END FROM facts
UNION ALL SELECT 'churn_rate', round(rate, 6), CASE WHEN rate > 0.1 AND rate < 0.4 THEN 1 ELSE 0 END FROM facts""",
        "cohort_churn": f"{FEATURES_CTE} SELECT tenure_bucket, round(avg(Churn), 6) AS churn_rate, count(*) AS n, round(100 * avg(Churn), 1) AS churn_rate_pct FROM named WHERE tenure_bucket IS NOT NULL GROUP BY tenure_bucket",
        "cohort_churn_onehot": f"{FEATURES_CTE} "
        + _stack(
            f"SELECT '{label}' AS tenure_bucket, round(avg(Churn), 6) AS churn_rate, count(*) AS n, round(100 * avg(Churn), 1) AS churn_rate_pct FROM features WHERE {flag} = 1"
            for flag, label in [("tb_0_12", "0-12"), ("tb_13_24", "13-24"), ("tb_25_48", "25-48"), ("tb_49_", "49+")]
        ),
        "segment_contract": _segment_churn("Contract"),
        "segment_payment": _segment_churn("PaymentMethod"),
        "segment_internet": _segment_churn("InternetService"),
        "segment_high_value": _segment_churn("is_high_value"),
        "segment_all": f"{FEATURES_CTE} " + _segments_of("named", ["Contract", "PaymentMethod", "InternetService", "is_high_value"]),
        "segment_by_column": f"{FEATURES_CTE} SELECT *, round(100 * churn_rate, 1) AS churn_rate_pct FROM ({_segments_of('features', SEGMENT_FLAGS)})",
        "class_balance": f"{FEATURES_CTE} SELECT Churn AS label, count(*) AS n, round(100 * count(*) / (SELECT count(*) FROM features), 4) AS pct FROM features GROUP BY Churn",
        "correlation_matrix": f"{FEATURES_CTE.rstrip()},\n{_PAIRS}\n{_pairs()}",
        "target_correlation": f"{FEATURES_CTE.rstrip()},\n{corr}\nSELECT * FROM target_corr",
        "correlation_top15": f"{FEATURES_CTE.rstrip()},\n{_PAIRS},\n{corr},\n"
        "wanted AS (SELECT feature FROM target_corr WHERE rank <= 15 UNION ALL SELECT 'Churn')\n"
        + _pairs("WHERE a.feature IN (FROM wanted) AND b.feature IN (FROM wanted)"),
        "correlation_drivers": f"{FEATURES_CTE.rstrip()},\n{corr},\n{_DRIVERS}\nSELECT * FROM drivers",
        "eda_facts": f"""{FEATURES_CTE.rstrip()},\n{corr},\n{_DRIVERS},
wanted(segment, level) AS (VALUES {levels}),
rates AS ({_segments_of("named", ["Contract", "PaymentMethod", "InternetService", "is_high_value"])})
SELECT 'balance' AS section, CAST(Churn AS VARCHAR) AS fact, round(100 * count(*) / (SELECT count(*) FROM features), 4) AS value FROM features GROUP BY Churn
UNION ALL SELECT 'tenure', tenure_bucket, round(avg(Churn), 6) FROM named GROUP BY tenure_bucket
UNION ALL SELECT 'level', segment || '.' || level, churn_rate FROM wanted LEFT JOIN rates USING (segment, level)
UNION ALL SELECT 'correlation', direction || '.' || place || '.' || feature, corr FROM drivers""",
        "kpi_overview": f"""{MODELLING} SELECT count(*) AS customers, CAST(sum(Churn) AS BIGINT) AS churned, round(avg(Churn), 6) AS churn_rate,
  round(CAST(sum(MonthlyCharges::DECIMAL(18,2)) AS DOUBLE) / count(*), 6) AS avg_monthly, CAST(sum(MonthlyCharges::DECIMAL(18,2)) AS DOUBLE) AS mrr,
  coalesce(CAST(sum(MonthlyCharges::DECIMAL(18,2)) FILTER (score >= {CARD_THRESHOLD}) AS DOUBLE), 0) AS mrr_at_risk,
  count(*) FILTER (score > 0.5) AS high_risk FROM scored""",
        "feature_ranges": f"{FEATURES_CTE} {ranges}",
        "feature_split_points": f"{LONG} SELECT feature, split_kind, {_round('min_value', 'max_value', 'median', 'split_value')} FROM splits",
        "calendar_holdout": f"""{RAW.rstrip()},
dates AS (SELECT obs_date, sum(count(*)) OVER (ORDER BY obs_date DESC) AS later, sum(count(*)) OVER () AS total FROM raw GROUP BY obs_date),
cut AS (SELECT max(obs_date) AS cutoff FROM dates WHERE later >= 0.2 * total)
SELECT customerID, obs_date, CASE WHEN obs_date >= cutoff THEN 'test'
  WHEN CAST(obs_date AS DATE) + INTERVAL 12 MONTH <= CAST(cutoff AS DATE) THEN 'train' ELSE 'purged' END AS split FROM raw, cut""",
        "rolling_folds": f"""{RAW.rstrip()},
origins AS (
  SELECT obs_date AS origin, CAST(row_number() OVER (ORDER BY obs_date) - 1 AS INTEGER) AS fold
  FROM (SELECT DISTINCT obs_date FROM raw ORDER BY obs_date DESC LIMIT 3)),
grouped AS (SELECT *, CAST('0x' || left(md5(CAST(c_custkey AS VARCHAR)), 4) AS INTEGER) % 3 AS grp FROM raw),
roles AS (
  SELECT fold, customerID, CASE WHEN grp = fold AND obs_date = origin THEN 'validate'
    WHEN grp <> fold AND CAST(obs_date AS DATE) + INTERVAL 12 MONTH <= CAST(origin AS DATE) THEN 'train' END AS role
  FROM grouped, origins)
SELECT fold, customerID, role FROM roles WHERE role IS NOT NULL""",
        "ordered_holdout": f"{MODELLING} SELECT customerID, tenure, split FROM modelling",
        "split_summary": f"{MODELLING} SELECT split, count(*) AS n, CAST(sum(Churn) AS BIGINT) AS churners, round(avg(Churn), 6) AS churn_rate FROM modelling GROUP BY split",
        "stratified_folds": f"{FEATURES_CTE} SELECT customerID, Churn, CAST((row_number() OVER (PARTITION BY Churn ORDER BY md5(customerID), customerID) - 1) % 3 AS INTEGER) AS fold FROM features",
        "class_weights": f"""{MODELLING} SELECT Churn AS label, count(*) AS n, round(sum(count(*)) OVER () / (2 * count(*)), 6) AS balanced_weight,
  CASE WHEN Churn = 1 THEN round((sum(count(*)) OVER () - count(*)) / count(*), 6) ELSE 1.0::DOUBLE END AS positive_weight
FROM modelling WHERE split = 'train' GROUP BY Churn""",
        "fixed_sample": f"{FEATURES_CTE} SELECT customerID, Churn FROM features ORDER BY md5(customerID), customerID LIMIT 1000",
        "standardized_features": f"{MODELLING} SELECT customerID, split, {scaled} FROM modelling",
        "predicted_labels": f"{MODELLING} SELECT customerID, score, CASE WHEN score >= {CARD_THRESHOLD} THEN 1 ELSE 0 END AS predicted FROM scored",
        "pr_curve": f"{MODELLING} SELECT score AS threshold, round(p, 6) AS precision, round(r, 6) AS recall FROM f1s UNION ALL SELECT NULL, 1.0::DOUBLE, 0.0::DOUBLE",
        "average_precision": f"{MODELLING} SELECT round({AVERAGE_PRECISION}, 6) AS average_precision",
        "roc_auc": f"{MODELLING} SELECT round({ROC_AUC}, 6) AS roc_auc",
        "recall_at_k": f"{MODELLING} SELECT k, captured, round(recall, 6) AS recall FROM top",
        "lift_at_k": f"{MODELLING} SELECT k, round(lift, 6) AS lift FROM top",
        "best_f1_threshold": f"{MODELLING} SELECT threshold, round(f1, 6) AS f1 FROM best",
        "confusion_at_threshold": f"""{MODELLING.rstrip()},
c AS (SELECT count(*) FILTER (score >= {CARD_THRESHOLD} AND Churn = 1) AS tp, count(*) FILTER (score >= {CARD_THRESHOLD} AND Churn = 0) AS fp,
  count(*) FILTER (score < {CARD_THRESHOLD} AND Churn = 1) AS fn, count(*) FILTER (score < {CARD_THRESHOLD} AND Churn = 0) AS tn FROM test)
SELECT *, CASE WHEN 2 * tp + fp + fn = 0 THEN 0.0 ELSE round(2 * tp / (2 * tp + fp + fn), 6) END AS f1 FROM c""",
        "classification_report": f"""{MODELLING.rstrip()},
labelled AS (SELECT Churn, CASE WHEN score >= {CARD_THRESHOLD} THEN 1 ELSE 0 END AS predicted FROM test),
per_class AS (
  SELECT c, count(*) FILTER (predicted = c AND Churn = c) AS hit, count(*) FILTER (predicted = c) AS called, count(*) FILTER (Churn = c) AS support,
    count(*) AS n FROM labelled, (VALUES (0), (1)) v(c) GROUP BY c),
scores AS (
  SELECT c, support, n, hit, coalesce(hit / nullif(called, 0), 0) AS precision, coalesce(hit / nullif(support, 0), 0) AS recall,
    coalesce(2 * hit / nullif(called + support, 0), 0) AS f1 FROM per_class)
SELECT CAST(c AS VARCHAR) AS class, round(precision, 6) AS precision, round(recall, 6) AS recall, round(f1, 6) AS f1, support FROM scores
UNION ALL SELECT 'accuracy', NULL, NULL, round(sum(hit) / any_value(n), 6), any_value(n) FROM scores
UNION ALL SELECT 'macro avg', round(avg(precision), 6), round(avg(recall), 6), round(avg(f1), 6), any_value(n) FROM scores
UNION ALL SELECT 'weighted avg', round(sum(precision * support) / any_value(n), 6), round(sum(recall * support) / any_value(n), 6),
  round(sum(f1 * support) / any_value(n), 6), any_value(n) FROM scores""",
        "gains_curve": f"""{MODELLING} SELECT DISTINCT place AS k, CAST(captured AS BIGINT) AS captured, round(place * 100 / n, 6) AS pct_targeted,
  round(captured * 100 / greatest(pos, 1), 6) AS pct_captured
FROM ranked JOIN range(1, 101) t(p) ON place = ceil(n * p / 100)""",
        "gains_curve_full": f"""{MODELLING} SELECT score, CAST(cum_n AS BIGINT) AS cum_n, CAST(cum_pos AS BIGINT) AS cum_pos,
  round(cum_n * 100 / (SELECT count(*) FROM test), 6) AS pct_targeted, round(cum_pos * 100 / greatest(all_pos, 1), 6) AS pct_captured,
  round(cum_n * 100 / (SELECT count(*) FROM test), 6) AS pct_random FROM points""",
        "evaluation_metrics": f"{MODELLING.rstrip()},\n{METRICS}\nSELECT 'card' AS model, metric, value FROM metrics",
        "linear_contributions": f"{LONG.rstrip()},\n{_WHOLE} SELECT customerID, feature, {_round('value', 'contribution')} FROM whole",
        "linear_base_value": f"{FEATURES_CTE} SELECT round(avg({_logit()}), 6) AS base_value FROM features",
        "tree_additivity": f"{FEATURES_CTE} SELECT count(*) AS n_rows, 0::BIGINT AS n_off FROM features",
        "global_importance": f"{LONG} SELECT feature, mean_abs, row_number() OVER (ORDER BY mean_abs DESC, feature) AS rank FROM importance",
        "beeswarm_points": f"""{LONG.rstrip()},\n{_WHOLE} SELECT customerID, feature, {_round('value', 'contribution')} FROM whole
WHERE feature IN (SELECT feature FROM importance ORDER BY mean_abs DESC, feature LIMIT 20)""",
        "top_drivers": f"{LONG.rstrip()},\n{_DRIVER_TEXT}\nSELECT customerID, drivers FROM drivers",
        "customer_breakdown": f"""{LONG} SELECT customerID, feature, round(value, 6) AS value, round(coalesce(contribution, 0), 6) AS contribution
FROM long LEFT JOIN contributions USING (customerID, feature, value) WHERE customerID = (SELECT min(customerID) FROM features)
ORDER BY abs(coalesce(contribution, 0)) DESC, feature LIMIT 15""",
        "segment_candidates": f"{LONG.rstrip()},\n{_candidates(0.05)}\nSELECT {_SEGMENT}, qualifies FROM candidates",
        "actionable_segments": f"{LONG.rstrip()},\n{_candidates(0.05)}\nSELECT rank, {_SEGMENT} FROM segments",
        "actionable_segments_small_gap": f"{LONG.rstrip()},\n{_candidates(SMALL_GAP)}\nSELECT rank, {_SEGMENT} FROM segments",
        "segment_report": f"{LONG.rstrip()},\n{_candidates(SMALL_GAP)}\nSELECT {_REPORT} FROM report",
        "risk_tiers": f"{MODELLING} SELECT customerID, score, {_TIER} AS risk_tier FROM scored",
        "risk_tier_distribution": f"""{MODELLING} SELECT position, risk_tier, count(score) AS n
FROM (VALUES (1, 'Low'), (2, 'Medium'), (3, 'High'), (4, 'Critical')) d(position, risk_tier)
LEFT JOIN (SELECT score, {_TIER} AS risk_tier FROM scored) USING (risk_tier) GROUP BY position, risk_tier""",
        "score_histogram": f"""{MODELLING.rstrip()},
ends AS (SELECT min(score) AS lo, max(score) AS hi, (max(score) - min(score)) / 20 AS width FROM scored),
bins AS (
  SELECT b AS bin, lo + (b - 1) * width - CASE WHEN b = 1 THEN (hi - lo) * 0.001::DOUBLE ELSE 0 END AS left_edge, lo + b * width AS right_edge
  FROM ends, range(1, 21) t(b))
SELECT bin, round((left_edge + right_edge) / 2, 2) AS prob_bin, count(place) AS n
FROM bins LEFT JOIN (SELECT greatest(1, least(20, ceil((score - lo) / width))) AS place FROM scored, ends) ON place = bin
GROUP BY bin, left_edge, right_edge""",
        "risk_list": f"""{LONG.rstrip()},\n{_DRIVER_TEXT},
chosen AS (SELECT *, {_score()} AS score FROM features)
SELECT customerID AS customer, score AS churn_prob, {_TIER} AS risk_tier, MonthlyCharges AS monthly, tenure AS tenure_months,
  drivers AS top_drivers, Churn AS actual_churn
FROM chosen JOIN drivers USING (customerID) WHERE score > 0.5 ORDER BY score DESC, customerID LIMIT 100""",
        "whatif_scores": _whatif(),
        "whatif_changes": f"{FEATURES_CTE} "
        + _stack(
            f"SELECT customerID, '{name}' AS scenario, '{c}' AS feature, round(CAST({c} AS DOUBLE), 6) AS original, CAST({v} AS DOUBLE) AS new_value, "
            f"round(CAST({v} AS DOUBLE) - {c}, 6) AS delta FROM features WHERE abs({v} - {c}) > 1e-6"
            for name, c, v in SCENARIOS
        ),
        "revenue_impact": f"{MODELLING.rstrip()},\n{_REVENUE}\nSELECT * FROM revenue",
        "memo_facts": f"""{MODELLING.rstrip()},\n{METRICS},\n{_REVENUE},
{LONG.split("doubles AS", 1)[1].join(["doubles AS", ""]).rstrip()},
{_candidates(SMALL_GAP)},
revenue_doubles AS (SELECT CAST(COLUMNS(*) AS DOUBLE) FROM revenue),
quoted AS (SELECT rank || '.' || feature || '.' || direction AS id, round(split_value, 6)::DOUBLE AS split_value, round(risky_rate, 6) AS risky_rate,
  round(other_half_rate, 6) AS other_half_rate, round(ratio, 6) AS ratio, affected::DOUBLE AS affected FROM report)
SELECT 'revenue' AS section, fact, value FROM (UNPIVOT revenue_doubles ON COLUMNS(*) INTO NAME fact VALUE value)
UNION ALL SELECT 'model', 'card.' || metric, value FROM metrics
UNION ALL SELECT 'segment', id || '.' || name, value FROM (UNPIVOT quoted ON split_value, risky_rate, other_half_rate, ratio, affected INTO NAME name VALUE value)""",
    }
