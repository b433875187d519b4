"""Oracle SQL per registered query, for DuckDB over the same test tables.

Every text starts from the raw derivation and computes the answer on one flat feature table, so it shares
nothing with the Spark plans but the input definition and column names.
"""

from __future__ import annotations

from math import exp

from holdfast.plans.contingency import FEATURES
from holdfast.plans.odds import DESIGN
from holdfast.sources.fixture import RAW_SQL, faulty_sql, faulty_star_sql
from holdfast.sources.schema import HEADER_OF, INTERNET_ADD_ONS, PREDICTION_COLUMNS, RAW_COLUMNS, STAR

# Fixed values, written out here and not taken from the engine, so that a wrong rule there shows: allowed raw values, and
# the rules of the star schema.
ALLOWED = {
    "gender": ["Male", "Female"],
    "senior_citizen": ["Yes", "No"],
    "partner": ["Yes", "No"],
    "dependents": ["Yes", "No"],
    "phone_service": ["Yes", "No"],
    "multiple_lines": ["Yes", "No", "No phone service"],
    "internet_service": ["DSL", "Fiber optic", "No"],
    "online_security": ["Yes", "No", "No internet service"],
    "online_backup": ["Yes", "No", "No internet service"],
    "device_protection": ["Yes", "No", "No internet service"],
    "tech_support": ["Yes", "No", "No internet service"],
    "streaming_tv": ["Yes", "No", "No internet service"],
    "streaming_movies": ["Yes", "No", "No internet service"],
    "contract": ["Month-to-month", "One year", "Two year"],
    "paperless_billing": ["Yes", "No"],
    "payment_method": ["Electronic check", "Mailed check", "Bank transfer (automatic)", "Credit card (automatic)"],
    "churn_label": ["Yes", "No"],
}
ENUMS = {
    "dim_subscriber": {
        "gender": ["Male", "Female"], "is_senior": ["Yes", "No"], "has_partner": ["Yes", "No"], "has_dependents": ["Yes", "No"],
    },
    "dim_service_profile": {
        "phone_service": ["Yes", "No"], "multiple_lines": ["Yes", "No"], "internet_service": ["DSL", "Fiber optic", "No"],
        "online_security": ["Yes", "No"], "online_backup": ["Yes", "No"], "device_protection": ["Yes", "No"],
        "tech_support": ["Yes", "No"], "streaming_tv": ["Yes", "No"], "streaming_movies": ["Yes", "No"],
    },
    "dim_contract": {"contract_type": ["Month-to-month", "One year", "Two year"], "paperless_billing": ["Yes", "No"]},
    "fact_prediction": {"risk_band": ["High", "Medium", "Low"]},
}
CODES = {
    "dim_subscriber": {"is_new_subscriber": [0, 1]},
    "dim_service_profile": {"has_protection_bundle": [0, 1], "fibre_without_support": [0, 1]},
    "dim_contract": {"is_autopay": [0, 1], "contract_commitment_months": [0, 12, 24]},
    "fact_attrition_label": {"churned_flag": [0, 1]},
    "fact_prediction": {"predicted_flag": [0, 1]},
}
RANGES = {
    "dim_subscriber": {"tenure_months": "tenure_months >= 0"},
    "dim_service_profile": {"services_count": "services_count >= 0"},
    "fact_billing": {"monthly_charge": "monthly_charge > 0", "lifetime_billed": "lifetime_billed >= 0"},
    "fact_prediction": {"risk_score": "risk_score BETWEEN 0 AND 1"},
}
PRIMARY_KEYS = {
    "dim_subscriber": ["subscriber_id"], "dim_service_profile": ["subscriber_id"], "dim_contract": ["subscriber_id"],
    "fact_billing": ["subscriber_id"], "fact_attrition_label": ["subscriber_id"],
    "fact_prediction": ["run_id", "subscriber_id", "model_name"], "model_run": ["run_id"],
}
REQUIRED_IN_REGISTRY = ["run_id", "model_name", "trained_at", "seed"]
CHILDREN = ["dim_service_profile", "dim_contract", "fact_billing", "fact_attrition_label", "fact_prediction"]

# Expression helpers --------------------------------------------------------------------------------------


def away(x: str, n: int) -> str:
    return f"(sign({x}) * floor(abs({x}) * 1e{n} + 5e-1) / 1e{n})"


def even(x: str, n: int) -> str:
    return f"(round_even(({x}) * 1e{n}, 0) / 1e{n})"


def rate(n: int = 4) -> str:
    return away("(sum(churned_flag)::DOUBLE / count(*))", n)


def msum(x: str) -> str:
    return f"sum(({x})::DECIMAL(18,2))::DOUBLE"


def mavg(x: str) -> str:
    return f"({msum(x)} / count({x}))"


def in_list(values: list) -> str:
    return "(" + ", ".join(str(v) if isinstance(v, int) else f"'{v}'" for v in values) + ")"


# Common tables -------------------------------------------------------------------------------------------

RAW_NAMES = [raw for _, raw, _, _ in RAW_COLUMNS] + ["churn_reason"]
TABLES = {"raw_subscribers": RAW_SQL.format(customer="customer", orders="orders")}

_plain = {raw: f"{raw} AS {name}" for _, raw, name, _ in RAW_COLUMNS}
_plain["total_charges"] = (
    "CASE WHEN tenure_months = 0 THEN coalesce(try_cast(total_charges AS DOUBLE), 0e0) "
    "ELSE try_cast(total_charges AS DOUBLE) END AS lifetime_billed"
)
_plain["multiple_lines"] = "replace(multiple_lines, 'No phone service', 'No') AS multiple_lines"
_plain["churn_label"] = "CASE churn_label WHEN 'Yes' THEN 1 WHEN 'No' THEN 0 END AS churned_flag"
for _c in INTERNET_ADD_ONS:
    _plain[_c] = f"replace({_c}, 'No internet service', 'No') AS {_c}"
TABLES["cleaned"] = "SELECT " + ", ".join(_plain.values()) + " FROM raw_subscribers"

_yes = lambda cols: " + ".join(f"({c} = 'Yes')::INT" for c in cols)
TABLES["features"] = f"""
SELECT *, {even('monthly_charge - avg_monthly_spend_to_date', 2)} AS price_vs_history_gap,
  (payment_method LIKE '%(automatic)')::INT AS is_autopay,
  (tenure_months <= 6)::INT AS is_new_subscriber,
  (internet_service = 'Fiber optic' AND online_security = 'No' AND tech_support = 'No')::INT AS fibre_without_support,
  CASE contract_type WHEN 'Month-to-month' THEN 0 WHEN 'One year' THEN 12 WHEN 'Two year' THEN 24 END
    AS contract_commitment_months
FROM (SELECT *,
  CASE WHEN tenure_months < 0 THEN 'nan' WHEN tenure_months > 72 THEN '73+ mo' WHEN tenure_months > 48 THEN '49–72 mo'
       WHEN tenure_months > 24 THEN '25–48 mo' WHEN tenure_months > 12 THEN '13–24 mo'
       WHEN tenure_months > 6 THEN '7–12 mo' ELSE '0–6 mo' END AS tenure_band,
  ({_yes(['phone_service', 'multiple_lines', *INTERNET_ADD_ONS])})::BIGINT AS services_count,
  (({_yes(['online_security', 'online_backup', 'device_protection', 'tech_support'])}) > 1)::INT AS has_protection_bundle,
  {even('lifetime_billed / greatest(tenure_months, 1)', 2)} AS avg_monthly_spend_to_date
  FROM cleaned)"""

TABLES["model_run"] = """
SELECT * FROM (VALUES (1, 'r1', 'logreg', '2026-01-01T00:00:00Z'), (2, 'r2', 'xgboost', '2026-01-02T00:00:00Z'),
  (3, 'r3', 'rf_calibrated', '2026-01-03T00:00:00Z'), (4, 'r4', 'xgb_calibrated', '2026-01-04T00:00:00Z'),
  (5, 'r5', 'tf_mlp', '2026-01-05T00:00:00Z')) AS r(n, run_id, model_name, trained_at)"""
TABLES["scores"] = """
SELECT r.run_id, r.model_name, f.*,
  (CASE WHEN f.churned_flag = 1 THEN 3500 ELSE 0 END
   + (substr(f.subscriber_id, 2)::BIGINT * 7919 + r.n * 4801) % 6500) / 1e4 AS risk_score
FROM features f CROSS JOIN model_run r WHERE r.n < 5"""
TABLES["predictions"] = """
SELECT *, CASE WHEN risk_score >= 55e-2 THEN 'High' WHEN risk_score >= 35e-2 THEN 'Medium' ELSE 'Low' END AS risk_band,
  (risk_score >= 5e-1)::INT AS predicted_flag
FROM scores"""
TABLES["calibrated"] = """
SELECT * FROM predictions WHERE run_id =
  (SELECT run_id FROM model_run WHERE model_name LIKE '%_calibrated' ORDER BY trained_at DESC LIMIT 1)"""
TABLES["watchlist"] = """
SELECT *, row_number() OVER (ORDER BY risk_score DESC, subscriber_id) AS place
FROM predictions WHERE run_id = (
  SELECT run_id FROM model_run
  WHERE model_name IN ('xgb_calibrated', 'rf_calibrated', 'xgboost', 'random_forest', 'logreg')
  ORDER BY list_position(['xgb_calibrated', 'rf_calibrated', 'xgboost', 'random_forest', 'logreg'], model_name),
           trained_at DESC LIMIT 1)"""


def on(last: str, body: str, **more: str) -> str:
    """SQL with every common table up to ``last``, the extra tables, and the body."""
    names = list(TABLES)
    parts = [f"{n} AS ({TABLES[n]})" for n in names[: names.index(last) + 1]]
    parts += [f"{n} AS ({text})" for n, text in more.items()]
    return "WITH " + ",\n".join(parts) + "\n" + body


# Raw table -----------------------------------------------------------------------------------------------

ORACLE: dict[str, str] = {
    "cleaned_subscribers": on("cleaned", "SELECT * FROM cleaned"),
    "features": on("features", "SELECT * FROM features"),
    "label_counts": on(
        "raw_subscribers",
        f"""SELECT churn_label, count(*) AS row_count, {even('count(*) / (SELECT count(*) FROM raw_subscribers)::DOUBLE', 4)} AS share
        FROM raw_subscribers WHERE churn_label IS NOT NULL GROUP BY churn_label""",
    ),
    "table_profile": on("raw_subscribers", "SELECT count(*) AS row_count, 22::BIGINT AS column_count FROM raw_subscribers"),
}

_rules = [("Total Charges blank → 0.0 for Tenure=0", "try_cast(total_charges AS DOUBLE) IS NULL",
           "Subscribers with tenure=0 have not yet been billed.")]
_rules += [(f"{HEADER_OF[c]}: ''No internet service'' → ''No''", f"{c} = 'No internet service'", "Simplifies encoding.")
           for c in INTERNET_ADD_ONS]
_rules += [("Multiple Lines: ''No phone service'' → ''No''", "multiple_lines = 'No phone service'", "Redundant."),
           ("Rename all columns to snake_case and drop leakage columns", "false", "Consistent naming."),
           ("churned_flag: ''Yes''/''No'' → 1/0", "true", "Binary target.")]
ORACLE["cleaning_log"] = on(
    "raw_subscribers",
    " UNION ALL ".join(
        f"SELECT '{rule}' AS rule, count(*) FILTER (WHERE {hit}) AS rows_affected, '{why}' AS rationale FROM raw_subscribers"
        for rule, hit, why in _rules
    ),
)


def _outside(c: str) -> str:
    hit = f"{c} NOT IN {in_list(ALLOWED[c])}"
    return f"({hit} OR {c} IS NULL)" if c == "senior_citizen" else hit


ORACLE["unexpected_values"] = on(
    "raw_subscribers",
    "SELECT column_name, value, count(*) AS row_count FROM ("
    + " UNION ALL ".join(
        f"SELECT '{HEADER_OF[c]}' AS column_name, {c} AS value FROM raw_subscribers WHERE {_outside(c)}" for c in ALLOWED
    )
    + ") GROUP BY column_name, value",
)


def _check(text: str, ok: str, bad: str, measured: str) -> str:
    return (
        f"SELECT {text} AS \"check\", CASE WHEN {ok} THEN 'PASS' ELSE '{bad}' END AS status, NULL::VARCHAR AS item, "
        f"({measured})::DOUBLE AS measured FROM raw_subscribers"
    )


_checks = [_check("'Required columns present (missing: none)'", "count(*) >= 0", "FAIL_CRITICAL", "0")]
_checks.append(
    _check(f"'CustomerID uniqueness (duplicates: ' || (count(*) - count(DISTINCT customer_id)) || ')'",
           "count(*) = count(DISTINCT customer_id)", "FAIL_CRITICAL", "count(*) - count(DISTINCT customer_id)")
)
for _c in ALLOWED:
    _n = f"count(*) FILTER (WHERE {_outside(_c)})"
    _checks.append(
        _check(f"'Allowed values for ''{HEADER_OF[_c]}'' (unexpected: ' || CASE WHEN {_n} = 0 THEN 'none' ELSE {_n} || ' rows' END || ')'",
               f"{_n} = 0", "FAIL_WARNING", _n)
    )
for _text, _low in (("Tenure Months >= 0", "tenure_months < 0"), ("Monthly Charges > 0", "monthly_charges <= 0")):
    _n = f"count(*) FILTER (WHERE {_low})"
    _checks.append(_check(f"'{_text} (violations: ' || {_n} || ')'", f"{_n} = 0", "FAIL_CRITICAL", _n))
_checks.append(_check("'Tenure Months max reasonable (<= 200 months)'", "max(tenure_months) <= 200", "FAIL_WARNING", "max(tenure_months)"))
_blank = "count(*) FILTER (WHERE try_cast(total_charges AS DOUBLE) IS NULL)"
_zero = "count(*) FILTER (WHERE tenure_months = 0)"
_checks.append(
    _check(f"'Total Charges blanks (' || {_blank} || ') match Tenure=0 rows (' || {_zero} || ')'", f"{_blank} = {_zero}",
           "FAIL_WARNING", _blank)
)
_checks += [
    f"SELECT 'Missingness report', 'INFO', '{HEADER_OF.get(c, 'Churn Reason')}', count(*)::DOUBLE FROM raw_subscribers WHERE {c} IS NULL HAVING count(*) > 0"
    for c in RAW_NAMES
]
_checks.append(
    f"SELECT 'Target distribution', 'INFO', 'churn_rate', {even('count(*) FILTER (WHERE churn_label = $$Yes$$) / count(*)::DOUBLE', 4)} FROM raw_subscribers".replace("$$", "'")
)
_checks.append(
    "SELECT 'Target distribution', 'INFO', churn_label, count(*)::DOUBLE FROM raw_subscribers WHERE churn_label IS NOT NULL GROUP BY churn_label"
)
ORACLE["validation_report"] = on("raw_subscribers", " UNION ALL ".join(_checks))

_fields = " || ".join(f"coalesce(length({c}::VARCHAR)::VARCHAR || ':' || {c}::VARCHAR, '-')" for c in RAW_NAMES)
_words = " || '-' || ".join(f"sum(('0x' || substr(h, {at}, 8))::BIGINT)::VARCHAR" for at in (1, 9, 17, 25))
ORACLE["table_fingerprint"] = on(
    "raw_subscribers", f"SELECT count(*) AS row_count, {_words} AS content_sum FROM (SELECT md5({_fields}) AS h FROM raw_subscribers)"
)

# Star schema ---------------------------------------------------------------------------------------------

for _t, _cols in STAR.items():
    ORACLE[_t] = on("features", f"SELECT subscriber_id, {', '.join(_cols)} FROM features")
ORACLE["subscriber_360"] = on("features", "SELECT * FROM features")
_WATCH = """subscriber_id, model_name, risk_score, risk_band, predicted_flag, tenure_months, tenure_band, is_senior,
  contract_type, payment_method, is_autopay, monthly_charge, churned_flag"""
ORACLE["scored_watchlist"] = on("watchlist", f"SELECT {_WATCH} FROM watchlist")
ORACLE["predictions_upsert"] = on(
    "calibrated",
    """SELECT run_id, subscriber_id, model_name,
      CASE WHEN run_id = 'r4' THEN round_even(least(9999e-4, risk_score + 5e-2) * 1e4, 0) / 1e4 ELSE risk_score END AS risk_score
    FROM predictions""",
)

_star_tables = {t: f"(SELECT subscriber_id, {', '.join(c)} FROM features)" for t, c in STAR.items()}
_star_tables["fact_prediction"] = f"(SELECT {', '.join(PREDICTION_COLUMNS)} FROM predictions)"
_star_tables["model_run"] = "(SELECT run_id, model_name, trained_at, 42 AS seed FROM model_run)"
_columns = {t: ["subscriber_id", *c] for t, c in STAR.items()}
_columns["fact_prediction"], _columns["model_run"] = PREDICTION_COLUMNS, REQUIRED_IN_REGISTRY


def _rule_counts(sources: dict[str, str]) -> str:
    """One row per rule; a key that is NULL in any part breaks no key rule."""
    lines = []

    def rule(table: str, kind: str, column: str, count: str) -> None:
        lines.append(
            f"SELECT '{table}' AS table_name, '{kind}' AS rule_kind, '{column}' AS column_name, ({count})::BIGINT AS violations "
            f"FROM {sources[table]}"
        )

    for t in sources:
        for c in _columns[t]:
            rule(t, "not_null", c, f"count(*) FILTER (WHERE {c} IS NULL)")
        for kind, sets in (("enum", ENUMS), ("code", CODES)):
            for c, values in sets.get(t, {}).items():
                rule(t, kind, c, f"count(*) FILTER (WHERE {c} NOT IN {in_list(values)})")
        for c, text in RANGES.get(t, {}).items():
            rule(t, "range", c, f"count(*) FILTER (WHERE NOT ({text}))")
        keys = PRIMARY_KEYS[t]
        known = " AND ".join(f"{c} IS NOT NULL" for c in keys)
        rule(t, "primary_key", ",".join(keys), f"count(*) FILTER (WHERE {known}) - count(DISTINCT ({', '.join(keys)})) FILTER (WHERE {known})")
    parents = f"SELECT subscriber_id FROM {sources['dim_subscriber']} WHERE subscriber_id IS NOT NULL"
    for t in CHILDREN:
        rule(t, "foreign_key", "subscriber_id", f"count(*) FILTER (WHERE subscriber_id NOT IN ({parents}))")
    return " UNION ALL ".join(lines)


_faulty = {t: f"({faulty_star_sql(t, _columns[t], source)})" for t, source in _star_tables.items()}
ORACLE["constraint_violations"] = on("predictions", _rule_counts(_star_tables))
ORACLE["constraint_violations_faulty"] = on(
    "predictions", _rule_counts({t: f"bad_{t}" for t in _faulty}), **{f"bad_{t}": f"SELECT * FROM {sql}" for t, sql in _faulty.items()}
)

# Reports -------------------------------------------------------------------------------------------------

_count = "count(*) AS subscriber_count, sum(churned_flag)::BIGINT AS churned_count"
_lost, _kept = "CASE WHEN churned_flag = 1 THEN monthly_charge END", "CASE WHEN churned_flag = 0 THEN monthly_charge END"


def over_features(body: str) -> str:
    return on("features", body)


ORACLE["kpi_summary"] = over_features(f"""
SELECT count(*) AS total_subscribers, sum(churned_flag)::BIGINT AS churned_count,
  sum(1 - churned_flag)::BIGINT AS retained_count, {rate()} AS attrition_rate,
  {away(msum('monthly_charge'), 2)} AS total_mrr, {away(msum(_lost), 2)} AS mrr_lost_to_churn,
  {away('avg(tenure_months)', 2)} AS avg_tenure_months, {away(mavg('monthly_charge'), 2)} AS avg_monthly_charge,
  {away(mavg(_lost), 2)} AS arpu_churned, {away(mavg(_kept), 2)} AS arpu_retained
FROM features""")
ORACLE["attrition_by_contract_and_tenure"] = over_features(f"""
SELECT contract_type, tenure_band, {_count}, {rate()} AS attrition_rate
FROM features GROUP BY ALL HAVING count(*) >= 50""")
for _name, _keys in (("payment_method_attrition", "payment_method, is_autopay"), ("services_count_vs_attrition", "services_count")):
    ORACLE[_name] = over_features(f"""
SELECT {_keys}, {_count}, {rate()} AS attrition_rate, {away(mavg('monthly_charge'), 2)} AS avg_monthly_charge
FROM features GROUP BY {_keys}""")
ORACLE["segment_lift"] = on(
    "features",
    f"""SELECT *, {away('(attrition_rate / base_rate)', 3)} AS lift_vs_base FROM (
      SELECT segment_dimension, segment_value, {_count}, {rate()} AS attrition_rate, (SELECT b FROM base) AS base_rate
      FROM tagged GROUP BY segment_dimension, segment_value HAVING count(*) >= 50)""",
    base=f"SELECT {rate(6)} AS b FROM features",
    tagged="""SELECT churned_flag, unnest([
      {'segment_dimension': 'Contract', 'segment_value': contract_type},
      {'segment_dimension': 'Internet Service', 'segment_value': internet_service},
      {'segment_dimension': 'Payment Method', 'segment_value': payment_method},
      {'segment_dimension': 'Senior Citizen', 'segment_value': is_senior}], recursive := true) FROM features""",
)
ORACLE["tenure_cohort_retention"] = over_features(f"""
SELECT a.tenure_months, a.n AS subscribers_at_tenure, (SELECT count(*) FROM features) AS total_subscribers,
  {away('((SELECT count(*) FROM features g WHERE g.churned_flag = 0 AND g.tenure_months >= a.tenure_months)::DOUBLE / (SELECT count(*) FROM features))', 4)}
  AS cumulative_share_retained
FROM (SELECT tenure_months, count(*) AS n FROM features WHERE churned_flag = 0 GROUP BY tenure_months) a""")
_weighted = "sum((monthly_charge * risk_score)::DECIMAL(28,8))::DOUBLE"
ORACLE["revenue_at_risk_by_band"] = on("calibrated", f"""
SELECT risk_band, count(DISTINCT subscriber_id) AS subscriber_count,
  {away('(sum(risk_score::DECIMAL(28,8))::DOUBLE / count(*))', 4)} AS avg_risk_score,
  {away(msum('monthly_charge'), 2)} AS total_mrr_in_band, {away(_weighted, 2)} AS revenue_at_risk,
  {away(mavg('monthly_charge'), 2)} AS avg_monthly_charge
FROM calibrated WHERE risk_band <> 'Low' GROUP BY risk_band""")
ORACLE["top_risk_within_segment"] = on("calibrated", """
SELECT contract_type, row_number() OVER (PARTITION BY contract_type ORDER BY risk_score DESC, subscriber_id)::INT AS rank_in_segment,
  subscriber_id, risk_score, risk_band, monthly_charge, tenure_months
FROM calibrated QUALIFY rank_in_segment <= 20""")
ORACLE["data_quality_checks"] = over_features(
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE subscriber_id IS NULL) AS null_id_count FROM features"
        for t in STAR
    )
)
ORACLE["data_quality_checks_faulty"] = on(
    "predictions",
    " UNION ALL ".join(
        f"SELECT '{t}' AS table_name, count(*) AS row_count, count(*) FILTER (WHERE subscriber_id IS NULL) AS null_id_count FROM {_faulty[t]}"
        for t in STAR
    ),
)
ORACLE["table_row_counts"] = over_features(
    " UNION ALL ".join(f"SELECT '{t}' AS table_name, count(*) AS row_count FROM features" for t in STAR)
    + f" UNION ALL SELECT 'total_records', {len(STAR)} * count(*) FROM features"
)
ORACLE["command_center_kpis"] = on("watchlist", f"""
SELECT count(*) AS total_subscribers, {even('sum(churned_flag)::DOUBLE / count(*) * 100', 1)} AS churn_rate,
  {even(msum('monthly_charge'), 2)} AS mrr, {even(msum(_lost), 2)} AS churned_mrr,
  (SELECT count(*) FROM watchlist) AS watchlist_count
FROM features""")
for _name, _keys in (
    ("churn_rate_by_contract", "contract_type"), ("churn_rate_by_payment", "payment_method"),
    ("churn_rate_by_internet", "internet_service"), ("services_stickiness", "services_count"),
    ("contract_tenure_heatmap", "contract_type, tenure_band"),
):
    ORACLE[_name] = over_features(f"""
SELECT {_keys}, {away('(sum(churned_flag)::DOUBLE / count(*) * 100)', 1)} AS churn_rate, count(*) AS "count"
FROM features GROUP BY {_keys}""")
ORACLE["severity_cluster"] = over_features(f"""
SELECT count(*) AS "count", {away(f"({msum('monthly_charge')} * 3)", 2)} AS quarterly_revenue
FROM features WHERE contract_type LIKE 'Month%' AND internet_service LIKE 'Fiber%' AND tenure_months <= 12""")
ORACLE["highest_charges"] = over_features(
    "SELECT * FROM features QUALIFY row_number() OVER (ORDER BY monthly_charge DESC, subscriber_id) <= 100"
)
ORACLE["insights_revenue_at_risk"] = on("calibrated", f"""
SELECT {even(f'coalesce({_weighted}, 0)', 2)} AS revenue_at_risk FROM calibrated WHERE risk_band <> 'Low'""")
ORACLE["insights_contract"] = over_features(f"""
SELECT contract_type, count(*) AS total, sum(churned_flag)::BIGINT AS churned, {rate()} AS churn_rate
FROM features GROUP BY contract_type""")

# Watchlist and planner -----------------------------------------------------------------------------------

ORACLE["top_risk_preview"] = on("watchlist", """
SELECT subscriber_id, contract_type, tenure_months, monthly_charge, risk_score, risk_band, payment_method
FROM watchlist WHERE place <= 3""")
ORACLE["call_list"] = on("watchlist", f"SELECT {_WATCH} FROM watchlist WHERE place <= 500")
for _name, _page in (("watchlist_page", 3), ("watchlist_deep_page", 200), ("watchlist_page_beyond", 10**6)):
    ORACLE[_name] = on("watchlist", f"""
SELECT subscriber_id, risk_score, risk_band, monthly_charge, tenure_months, contract_type, payment_method, is_autopay,
  churned_flag, total, greatest(1, ceil(total / 6e0))::BIGINT AS total_pages
FROM (SELECT count(*) AS total FROM watchlist) LEFT JOIN (SELECT * FROM watchlist WHERE place > {_page} * 6 - 6 AND place <= {_page} * 6)
  ON true""")
ORACLE["watchlist_kpi"] = on("watchlist", f"""
SELECT count(*) AS "count", {away(f"({msum('monthly_charge')} * 12)", 2)} AS arr,
  {away(f"({mavg('monthly_charge')} * 12)", 2)} AS avg_arr FROM watchlist""")
ORACLE["watchlist_detail"] = on("watchlist", f"""
SELECT {_WATCH}, gender, has_partner, has_dependents, internet_service, services_count, online_security, tech_support,
  streaming_tv, streaming_movies FROM watchlist WHERE subscriber_id = 'S1'""")
_cohort = f"SELECT count(*) AS n, {mavg('monthly_charge')} AS a FROM watchlist WHERE risk_score >= 42e-2"


def _plan_steps(cost: str, percent: str, horizon: str, source: str) -> dict[str, str]:
    return {
        "s1": f"SELECT *, {even(f'n * {cost}', 2)} AS outreach_budget, round_even(n * ({percent} / 1e2), 0)::BIGINT AS expected_saves FROM {source}",
        "s2": f"SELECT *, {even('expected_saves * a', 2)} AS gross_saved_mrr FROM s1",
        "s3": f"SELECT *, {even(f'gross_saved_mrr * {horizon} - outreach_budget', 2)} AS net_impact FROM s2",
    }


_roi = f"CASE WHEN outreach_budget > 0 THEN {even('net_impact / outreach_budget', 1)} ELSE 0e0 END AS roi"
ORACLE["retention_plan"] = on(
    "watchlist",
    f"""SELECT n AS cohort_count, a AS avg_mrr, outreach_budget, expected_saves, gross_saved_mrr, net_impact, {_roi},
    42e-2 AS optimal_threshold FROM s3""",
    cohort=_cohort, **_plan_steps("185e-1", "22e0", "12", "cohort"),
)
_grid = """SELECT * FROM cohort, (SELECT unnest(range(10, 201, 5))::INT AS offer_cost),
  (SELECT unnest(range(5, 61))::INT AS save_percent), (SELECT unnest(range(3, 37))::INT AS horizon_months)"""
ORACLE["retention_plan_grid"] = on(
    "watchlist",
    f"SELECT offer_cost, save_percent, horizon_months, outreach_budget, expected_saves, gross_saved_mrr, net_impact, {_roi} FROM s3",
    cohort=_cohort, grid=_grid,
    **_plan_steps("offer_cost::DOUBLE", "save_percent::DOUBLE", "horizon_months", "grid"),
)
ORACLE["retention_value_grid"] = on(
    "watchlist",
    f"""SELECT offer_cost, save_percent, horizon_months,
    {even('n * (save_percent::DOUBLE / 1e2) * a * horizon_months - n * offer_cost::DOUBLE', 2)} AS net_value FROM grid""",
    cohort=_cohort, grid=_grid,
)

# Model quality -------------------------------------------------------------------------------------------

_ratio10 = lambda a, b: away(f"(({a})::DOUBLE / ({b}))", 10)
_METRIC_TABLES = {
    "confusion": f"""SELECT run_id, model_name, {_ratio10('sum((churned_flag = predicted_flag)::INT)', 'count(*)')} AS accuracy,
      coalesce({_ratio10('sum(churned_flag * predicted_flag)', 'nullif(sum(predicted_flag), 0)')}, 0e0) AS "precision",
      coalesce({_ratio10('sum(churned_flag * predicted_flag)', 'nullif(sum(churned_flag), 0)')}, 0e0) AS recall,
      coalesce({_ratio10('2 * sum(churned_flag * predicted_flag)', 'nullif(sum(predicted_flag) + sum(churned_flag), 0)')}, 0e0) AS f1,
      {_ratio10('sum(((risk_score - churned_flag) * (risk_score - churned_flag))::DECIMAL(28,12))', 'count(*)')} AS brier
      FROM predictions GROUP BY run_id, model_name""",
    "hist": """SELECT run_id, model_name, risk_score, sum(churned_flag) AS pos, sum(1 - churned_flag) AS neg
      FROM predictions GROUP BY run_id, model_name, risk_score""",
    "curve": """SELECT *, sum(pos) OVER up AS tp, sum(pos + neg) OVER up AS flagged, sum(pos) OVER grp AS np,
      sum(neg) OVER grp AS nn, coalesce(sum(neg) OVER (PARTITION BY run_id, model_name ORDER BY risk_score
        ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS neg_below FROM hist
      WINDOW up AS (PARTITION BY run_id, model_name ORDER BY risk_score DESC), grp AS (PARTITION BY run_id, model_name)""",
    "ranking": f"""SELECT run_id, model_name,
      {_ratio10('sum(pos * (2 * neg_below + neg))', '2e0 * max(np) * max(nn)')} AS roc_auc,
      {_ratio10('sum(pos * (tp::DOUBLE / flagged))', 'max(np)')} AS pr_auc FROM curve GROUP BY run_id, model_name""",
}
ORACLE["classification_metrics"] = on(
    "predictions", "SELECT * FROM confusion JOIN ranking USING (run_id, model_name)", **_METRIC_TABLES
)
ORACLE["model_leaderboard"] = on(
    "predictions",
    """SELECT r.run_id, r.model_name, roc_auc AS test_auc, "precision" AS test_precision, recall AS test_recall, f1 AS test_f1,
      trained_at FROM model_run r LEFT JOIN confusion c ON c.run_id = r.run_id LEFT JOIN ranking k ON k.run_id = r.run_id""",
    **_METRIC_TABLES,
)
ORACLE["optimal_threshold"] = on(
    "predictions",
    f"""SELECT run_id, model_name, i / 1e2 AS best_threshold, f1_threshold, net_value AS best_net_value,
      {away('(i / 1e2)', 4)} AS high_cutoff, {away('least(i / 1e2 * 7e-1, f1_threshold)', 4)} AS medium_cutoff
      FROM best JOIN f1 USING (run_id, model_name)""",
    hist=_METRIC_TABLES["hist"], curve=_METRIC_TABLES["curve"],
    grid=f"""SELECT run_id, model_name, i, {away('(tp * 2e-1 * coalesce(charge / nullif(tp, 0), 0e0) * 12 - contacts * 50e0)', 6)} AS net_value
      FROM (SELECT run_id, model_name, i, count(*) FILTER (WHERE risk_score >= i / 1e2) AS contacts,
        count(*) FILTER (WHERE risk_score >= i / 1e2 AND churned_flag = 1) AS tp,
        coalesce(sum(monthly_charge::DECIMAL(18,2)) FILTER (WHERE risk_score >= i / 1e2 AND churned_flag = 1)::DOUBLE, 0e0) AS charge
        FROM predictions, (SELECT unnest(range(1, 100)) AS i) GROUP BY run_id, model_name, i)""",
    best="SELECT * FROM grid QUALIFY row_number() OVER (PARTITION BY run_id, model_name ORDER BY net_value DESC, i) = 1",
    f1="""SELECT run_id, model_name, risk_score AS f1_threshold FROM curve QUALIFY row_number() OVER (
      PARTITION BY run_id, model_name ORDER BY 2 * ((tp::DOUBLE / flagged) * (tp::DOUBLE / np))
        / (tp::DOUBLE / flagged + tp::DOUBLE / np + 1e-9) DESC, risk_score) = 1""",
)

# Statistics ----------------------------------------------------------------------------------------------


def upper_gamma(a: str, x: str) -> str:
    """1 - P(a, x) by the series of the lower incomplete gamma function."""
    return f"""greatest(0e0, 1 - coalesce((SELECT sum(exp(-({x}) + (({a}) + i) * ln({x}) - lgamma(({a}) + i + 1)))
      FROM (SELECT unnest(range(0, 4000)) AS i)), 0e0))"""


def v_label(x: str) -> str:
    return f"CASE WHEN {x} >= 35e-2 THEN 'large' WHEN {x} >= 2e-1 THEN 'moderate' WHEN {x} >= 1e-1 THEN 'small' ELSE 'negligible' END"


def d_label(x: str) -> str:
    return f"CASE WHEN abs({x}) >= 8e-1 THEN 'large' WHEN abs({x}) >= 5e-1 THEN 'moderate' WHEN abs({x}) >= 2e-1 THEN 'small' ELSE 'negligible' END"


def significant(test: str) -> str:
    return f"CASE WHEN {test} THEN 'statistically significant' ELSE 'not statistically significant' END"


ORACLE["association_tests"] = on(
    "features",
    f"""SELECT feature, 'chi-square' AS test, chi2, dof, p_raw, cramers_v, effect_size_label, {even('p_exact', 6)} AS p_adjusted,
      p_exact <= 5e-2 AS bh_significant,
      'The association between ' || replace(feature, '_', ' ') || ' and subscriber attrition is ' || {significant('p_exact <= 5e-2')}
      || printf(' (adjusted p = %.3f) with a ', {even('p_exact', 6)}) || {v_label('cramers_v')}
      || printf(' effect size (Cramér''s V = %.3f). Correlation only — no causal claim is made.', cramers_v) AS plain_english
      FROM adjusted""",
    cells=" UNION ALL ".join(
        f"SELECT '{f}' AS feature, {f}::VARCHAR AS value, c AS label, count(*) FILTER (WHERE churned_flag = c) AS o FROM features, (SELECT unnest([0, 1]) AS c) GROUP BY ALL"
        for f in FEATURES
    ),
    expected="""SELECT *, sum(o) OVER (PARTITION BY feature, value) * sum(o) OVER (PARTITION BY feature, label)
      / (sum(o) OVER (PARTITION BY feature))::DOUBLE AS e, (count(DISTINCT value) OVER (PARTITION BY feature)) - 1 AS dof FROM cells""",
    tests="""SELECT feature, dof, sum(o) AS n, sum(power(abs(o - e) - CASE WHEN dof = 1 THEN least(5e-1, abs(o - e)) ELSE 0 END, 2) / e) AS x
      FROM expected GROUP BY feature, dof""",
    rounded=f"""SELECT feature, dof::BIGINT AS dof, {even('x', 4)} AS chi2, {even('p', 6)} AS p_raw, {even('sqrt(x / n)', 4)} AS cramers_v,
      {v_label('sqrt(x / n)')} AS effect_size_label FROM (SELECT *, {upper_gamma('t.dof / 2e0', 't.x / 2e0')} AS p FROM tests t)""",
    ranked="SELECT *, p_raw * count(*) OVER () / row_number() OVER (ORDER BY p_raw, feature) AS w, row_number() OVER (ORDER BY p_raw, feature) AS k FROM rounded",
    adjusted="SELECT *, least(1e0, (SELECT min(q.w) FROM ranked q WHERE q.k >= r.k)) AS p_exact FROM ranked r",
)

_mid = "(t.low + (t.i + 5e-1) * t.step)"
ORACLE["numeric_tests"] = on(
    "features",
    f"""SELECT feature, n1 AS n_churned, n2 AS n_retained, {even('m1', 3)} AS mean_churned, {even('m2', 3)} AS mean_retained,
      {even('s1', 3)} AS std_churned, {even('s2', 3)} AS std_retained, {even('g1', 3)} AS skew_churned, {even('g2', 3)} AS skew_retained,
      {even('t', 4)} AS t_stat, {even('pt', 6)} AS p_ttest, {even('u', 1)} AS u_stat, {even('pu', 6)} AS p_mwu, {even('d', 4)} AS cohens_d,
      {d_label('d')} AS effect_label, {even('1 - 2e0 * u / (n1 * n2)', 4)} AS rank_biserial_r,
      'Churned subscribers have ' || CASE WHEN m1 > m2 THEN 'higher ' ELSE 'lower ' END || replace(feature, '_', ' ')
      || printf(' on average (churned: %.1f, retained: %.1f). The difference is ', {even('m1', 3)}, {even('m2', 3)})
      || {significant(even('pt', 6) + ' < 5e-2')} || printf(' (t-test p = %.4f), with a ', {even('pt', 6)}) || {d_label(even('d', 4))}
      || printf(' effect (Cohen''s d = %.3f). Correlation only — no causal claim is made.', {even('d', 4)}) AS plain_english
      FROM tails""",
    vals="""SELECT 'tenure_months' AS feature, tenure_months::DOUBLE AS v, churned_flag AS c FROM features
      UNION ALL SELECT 'monthly_charge', monthly_charge, churned_flag FROM features""",
    means="SELECT feature, c, count(*) AS n, avg(v) AS m FROM vals GROUP BY feature, c",
    groups="""SELECT feature, c, any_value(n) AS n, any_value(m) AS m, sqrt(sum(power(v - m, 2)) / (count(*) - 1)) AS s,
      (sum(power(v - m, 3)) / count(*)) / power(sum(power(v - m, 2)) / count(*), 15e-1) AS g
      FROM vals JOIN means USING (feature, c) GROUP BY feature, c""",
    hist="SELECT feature, v, sum(c) AS p, sum(1 - c) AS q FROM vals GROUP BY feature, v",
    ranks="SELECT *, coalesce(sum(q) OVER (PARTITION BY feature ORDER BY v ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS b FROM hist",
    us="SELECT feature, sum(p * (b + q / 2e0)) AS u, sum(power((p + q)::DOUBLE, 3) - (p + q)) AS ties FROM ranks GROUP BY feature",
    sides="""SELECT a.feature, a.n AS n1, b.n AS n2, a.m AS m1, b.m AS m2, a.s AS s1, b.s AS s2, a.g AS g1, b.g AS g2, u, ties,
      a.s * a.s / a.n AS va, b.s * b.s / b.n AS vb
      FROM groups a JOIN groups b ON b.feature = a.feature AND b.c = 0 JOIN us ON us.feature = a.feature WHERE a.c = 1""",
    stat="""SELECT *, (m1 - m2) / sqrt(va + vb) AS t, power(va + vb, 2) / (va * va / (n1 - 1) + vb * vb / (n2 - 1)) AS df,
      (m1 - m2) / sqrt(((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2) / (n1 + n2 - 2)) AS d,
      (greatest(u, n1 * n2 - u) - n1 * n2 / 2e0 - 5e-1)
        / sqrt(n1 * n2 / 12e0 * (n1 + n2 + 1 - ties / ((n1 + n2)::DOUBLE * (n1 + n2 - 1)))) AS z FROM sides""",
    area="""SELECT feature, sum(exp(lgamma((df + 1) / 2) - lgamma(df / 2)) / sqrt(df * pi())
      * power(1 + power((i + 5e-1) * abs(t) / 20000, 2) / df, -(df + 1) / 2) * abs(t) / 20000) AS half
      FROM stat, (SELECT unnest(range(0, 20000)) AS i) GROUP BY feature""",
    tails=f"""SELECT s.*, greatest(0e0, 1 - 2 * half) AS pt, {upper_gamma('5e-1', 's.z * s.z / 2')} AS pu
      FROM stat s JOIN area USING (feature)""",
)



def _poisson_steps(rate: int) -> str:
    """Ends of the 15-bit draws that mean 0, 1, 2, ... rows."""
    terms, ends = [exp(-rate)], []
    while round(sum(terms) * 32768) < 32768:
        ends.append(round(sum(terms) * 32768))
        terms.append(terms[-1] * rate / len(terms))
    return str(ends)


_bytes = " + ".join(f"('0x' || substr(b, {at}, 2))::INT" for at in range(1, 25, 2))
ORACLE["bootstrap_intervals"] = on(
    "features",
    f"""SELECT feature, {even('quantile_cont(d, 25e-3)', 3)} AS bootstrap_ci_lo, {even('quantile_cont(d, 975e-3)', 3)} AS bootstrap_ci_hi
      FROM (SELECT feature, i, sum(w * v) FILTER (WHERE c = 1) / sum(w) FILTER (WHERE c = 1)
        - sum(w * v) FILTER (WHERE c = 0) / sum(w) FILTER (WHERE c = 0) AS d FROM weighted GROUP BY feature, i) GROUP BY feature""",
    vals="""SELECT 'tenure_months' AS feature, tenure_months::DOUBLE AS v, churned_flag AS c FROM features
      UNION ALL SELECT 'monthly_charge', monthly_charge, churned_flag FROM features""",
    keyed="""SELECT feature, v, c, n, i, '42|' || feature || '|' || printf('%.4f', v) || '|' || c || '|' || i AS k
      FROM (SELECT feature, v, c, count(*) AS n FROM vals GROUP BY ALL), (SELECT unnest(range(2000)) AS i)""",
    hashed="SELECT *, ('0x' || substr(md5(k || '|a'), 1, 15))::BIGINT AS a, md5(k || '|b') AS b FROM keyed",
    weighted="SELECT *, " + " + ".join(f"CASE WHEN n & {1 << k} > 0 THEN len(list_filter({_poisson_steps(1 << k)}, lambda t: t <= (a >> {15 * k}) & 32767)) ELSE 0 END" for k in range(4))
    + f""" + CASE WHEN n >= 16 THEN greatest(0e0, floor((n - n % 16) + sqrt((n - n % 16)::DOUBLE) * (({_bytes}) - 1530) / sqrt(65535e0) + 5e-1)) ELSE 0e0 END AS w
      FROM hashed""",
)

_PY = {n: f"({e})::INT::DOUBLE" if "=" in e else f"({e})::DOUBLE" for n, e in DESIGN.items()}
_DESIGN_SQL = "SELECT [" + ", ".join(_PY.values()) + "] AS x FROM features"
_gram = "SELECT i, j, sum(x[i] * x[j]) AS s FROM design, (SELECT unnest(range(1, 16)) AS i), (SELECT unnest(range(1, 16)) AS j) GROUP BY i, j"
ORACLE["gram_matrix"] = on(
    "features", f"SELECT i::INT AS i, j::INT AS j, {away('s', 4)} AS s FROM gram WHERE j >= i", design=_DESIGN_SQL, gram=_gram
)
_names = "[" + ", ".join(f"'{n}'" for n in DESIGN) + "]"
ORACLE["vif"] = on(
    "features",
    f"""SELECT {_names}[i] AS feature, {even('g.s * inv.m[i][i]', 2)} AS vif
      FROM gram g, (SELECT m FROM swept WHERE k = 15) inv WHERE g.i = g.j""",
    design=_DESIGN_SQL,
    gram=_gram,
    matrix="SELECT list(r ORDER BY i) AS m FROM (SELECT i, list(s ORDER BY j) AS r FROM gram GROUP BY i)",
    swept="""SELECT 0 AS k, m FROM matrix UNION ALL
      SELECT k + 1, list_transform(range(1, 16), lambda i: list_transform(range(1, 16), lambda j:
        CASE WHEN i = k + 1 AND j = k + 1 THEN 1 / m[k + 1][k + 1]
             WHEN i = k + 1 THEN m[i][j] / m[k + 1][k + 1]
             WHEN j = k + 1 THEN -m[i][j] / m[k + 1][k + 1]
             ELSE m[i][j] - m[i][k + 1] * m[k + 1][j] / m[k + 1][k + 1] END))
      FROM swept WHERE k < 15""",
).replace("WITH ", "WITH RECURSIVE ", 1)

# Logistic fit: Newton steps over counted rows; each inverts the information matrix by sweeping its pivots in turn.
_STEPS, _WIDTH = 10, len(DESIGN) + 1
_sweep = f"""list_reduce(list_concat([m], list_transform(range(1, {_WIDTH + 1}), lambda k: [[k::DOUBLE]])), lambda a, e:
  list_transform(range(1, {_WIDTH + 1}), lambda i: list_transform(range(1, {_WIDTH + 1}), lambda j:
    CASE WHEN i = e[1][1] AND j = e[1][1] THEN 1 / a[i][j]
         WHEN i = e[1][1] THEN a[i][j] / a[i][i]
         WHEN j = e[1][1] THEN -a[i][j] / a[j][j]
         ELSE a[i][j] - a[i][e[1][1]::INT] * a[e[1][1]::INT][j] / a[e[1][1]::INT][e[1][1]::INT] END)))"""
_newton = {
    "cells": "SELECT x, count(*) AS n, sum(y) AS y FROM (SELECT [1e0, " + ", ".join(_PY.values()) + "] AS x, churned_flag AS y FROM features) GROUP BY x",
    "b0": f"SELECT list_transform(range({_WIDTH}), lambda i: 0e0) AS b",
}
for _t in range(_STEPS):
    _newton |= {
        f"p{_t}": f"SELECT x, n, y, 1 / (1 + exp(-list_dot_product(x, b))) AS p FROM cells, b{_t}",
        f"g{_t}": f"""SELECT i, list(s ORDER BY j) AS r FROM (SELECT i, j, sum(n * p * (1 - p) * x[i] * x[j]) AS s
          FROM p{_t}, (SELECT unnest(range(1, {_WIDTH + 1})) AS i), (SELECT unnest(range(1, {_WIDTH + 1})) AS j) GROUP BY i, j) GROUP BY i""",
        f"u{_t}": f"SELECT list(s ORDER BY i) AS u FROM (SELECT i, sum((y - n * p) * x[i]) AS s FROM p{_t}, (SELECT unnest(range(1, {_WIDTH + 1})) AS i) GROUP BY i)",
        f"v{_t}": f"SELECT {_sweep} AS v FROM (SELECT list(r ORDER BY i) AS m FROM g{_t})",
        f"b{_t + 1}": f"SELECT list_transform(range(1, {_WIDTH + 1}), lambda i: b[i] + list_dot_product(v[i], u)) AS b FROM b{_t}, v{_t}, u{_t}",
    }
ORACLE["odds_ratios"] = on(
    "features",
    f"""SELECT *, p_value < 5e-2 AS significant, 'A one-unit increase in ' || replace(feature, '_', ' ') || ' is associated with an odds ratio of '
      || printf('%.2f (95%% CI: %.2f–%.2f), ', odds_ratio, or_ci_lo, or_ci_hi) || CASE WHEN p_value < 5e-2 THEN 'significant' ELSE 'not significant' END
      || printf(' at p = %.3f. Correlation only — no causal claim is made.', p_value) AS plain_english
      FROM (SELECT feature, {even('c', 4)} AS log_odds, {even('exp(c)', 4)} AS odds_ratio, {even('exp(c - 1.959963984540054e0 * se)', 4)} AS or_ci_lo,
        {even('exp(c + 1.959963984540054e0 * se)', 4)} AS or_ci_hi, {even('p', 6)} AS p_value
        FROM (SELECT *, {upper_gamma('5e-1', 'f.c * f.c / f.se / f.se / 2')} AS p FROM fitted f))""",
    **_newton,
    fitted=f"SELECT {_names}[i] AS feature, b[i + 1] AS c, sqrt(v[i + 1][i + 1]) AS se FROM b{_STEPS}, v{_STEPS - 1}, (SELECT unnest(range(1, {_WIDTH})) AS i)",
)

_LIFE = {
    "life": """SELECT contract_type, t, events, sum(ended) OVER (PARTITION BY contract_type ORDER BY t DESC) AS n FROM (
      SELECT contract_type, tenure_months::DOUBLE AS t, sum(churned_flag) AS events, count(*) AS ended FROM features GROUP BY ALL
      UNION ALL SELECT DISTINCT contract_type, 0e0, 0, 0 FROM features f
        WHERE NOT EXISTS (SELECT 1 FROM features z WHERE z.contract_type = f.contract_type AND z.tenure_months = 0))""",
    "km": f"""SELECT t AS timeline, contract_type, {away('product(1 - events / n::DOUBLE) OVER (PARTITION BY contract_type ORDER BY t)', 10)}
      AS survival_prob FROM life""",
}
ORACLE["km_curves"] = on("features", "SELECT timeline, survival_prob, contract_type FROM km", **_LIFE)
ORACLE["km_summary"] = on(
    "features",
    f"""SELECT contract_type, n_subscribers, n_events, median_survival_months,
      contract_type || printf(' subscribers: %.1f%% attrition rate. Median retention: ', n_events / n_subscribers::DOUBLE * 100)
      || coalesce(median_survival_months::BIGINT || ' months', 'not reached (>50% still active)')
      || printf('. Global log-rank test: p = %.4f ', p) || CASE WHEN p < 5e-2 THEN '(' ELSE '(not ' END
      || 'significant difference across groups).' AS plain_english,
      {even('p', 6)} AS logrank_p_global, p < 5e-2 AS logrank_significant
      FROM sizes JOIN medians USING (contract_type), pvalue""",
    **_LIFE,
    sizes="SELECT contract_type, count(*) AS n_subscribers, sum(churned_flag)::BIGINT AS n_events FROM features GROUP BY contract_type",
    medians="SELECT contract_type, min(timeline) FILTER (WHERE survival_prob <= 5e-1) AS median_survival_months FROM km GROUP BY contract_type",
    counts="""SELECT t, count(*) FILTER (WHERE tenure_months >= t)::DOUBLE AS n,
      count(*) FILTER (WHERE tenure_months = t AND churned_flag = 1)::DOUBLE AS d,
      count(*) FILTER (WHERE tenure_months >= t AND contract_type = 'Month-to-month')::DOUBLE AS n1,
      count(*) FILTER (WHERE tenure_months = t AND churned_flag = 1 AND contract_type = 'Month-to-month')::DOUBLE AS d1,
      count(*) FILTER (WHERE tenure_months >= t AND contract_type = 'One year')::DOUBLE AS n2,
      count(*) FILTER (WHERE tenure_months = t AND churned_flag = 1 AND contract_type = 'One year')::DOUBLE AS d2
      FROM features, (SELECT DISTINCT tenure_months AS t FROM features) GROUP BY t""",
    sums="""SELECT sum(d1 - d * n1 / n) AS z1, sum(d2 - d * n2 / n) AS z2,
      sum(w * n1 / n * (1 - n1 / n)) AS v11, sum(w * n2 / n * (1 - n2 / n)) AS v22, -sum(w * n1 / n * n2 / n) AS v12
      FROM (SELECT *, d * coalesce((n - d) / nullif(n - 1, 0), 1) AS w FROM counts)""",
    pvalue="SELECT exp(-(z1 * z1 * v22 - 2 * z1 * z2 * v12 + z2 * z2 * v11) / (v11 * v22 - v12 * v12) / 2) AS p FROM sums",
)

# Faulty raw table ------------------------------------------------------------------------------------------

ORACLE["deduplicated_features"] = on("features", "SELECT DISTINCT * FROM features")
_sound = f"raw_subscribers AS ({TABLES['raw_subscribers']})"
_faulty = f"raw_sound AS ({TABLES['raw_subscribers']}),\nraw_subscribers AS ({faulty_sql(RAW_NAMES, 'raw_sound')})"
for _name in (
    "cleaned_subscribers", "cleaning_log", "validation_report", "unexpected_values", "label_counts", "table_fingerprint",
    "deduplicated_features",
):
    ORACLE[f"{_name}_faulty"] = ORACLE[_name].replace(_sound, _faulty)
del ORACLE["deduplicated_features"]

# Training inputs -------------------------------------------------------------------------------------------

_split = lambda at: f"('0x' || substr(md5(subscriber_id || '|42'), {at}, 8))::BIGINT"
ORACLE["training_split"] = on(
    "features", f"SELECT subscriber_id, {_split(1)} % 100 < 20 AS held_out, ({_split(9)} % 5)::INT AS fold, churned_flag AS label FROM features"
)
# The isotonic value at i is the largest, over starts j <= i, of the smallest mean of j..k over ends k >= i.
ORACLE["calibration_curves"] = on(
    "predictions",
    f"""SELECT run_id, model_name, risk_score, {away('value', 9)} AS calibrated FROM (
      SELECT e.run_id, e.model_name, e.risk_score, max(e.low) AS value FROM least_mean e GROUP BY e.run_id, e.model_name, e.risk_score)""",
    hist=_METRIC_TABLES["hist"],
    ranked="""SELECT *, row_number() OVER w AS i, sum(pos) OVER w AS p, sum(pos + neg) OVER w AS n FROM hist
      WINDOW w AS (PARTITION BY run_id, model_name ORDER BY risk_score)""",
    least_mean="""SELECT k.run_id, k.model_name, k.risk_score, min((k.p - j.p + j.pos)::DOUBLE / (k.n - j.n + j.pos + j.neg)) OVER (
        PARTITION BY k.run_id, k.model_name, j.i ORDER BY k.i DESC) AS low
      FROM ranked j JOIN ranked k ON j.run_id = k.run_id AND j.model_name = k.model_name AND j.i <= k.i""",
)
_SCALED = [
    "tenure_months", "monthly_charge", "lifetime_billed", "services_count", "avg_monthly_spend_to_date", "price_vs_history_gap",
]
_LEVELS = {  # all levels of a category but the reference level
    "gender": ["Male"], "is_senior": ["Yes"], "has_partner": ["Yes"], "has_dependents": ["Yes"], "phone_service": ["Yes"],
    "multiple_lines": ["Yes"], "internet_service": ["Fiber optic", "No"], "online_security": ["Yes"], "online_backup": ["Yes"],
    "device_protection": ["Yes"], "tech_support": ["Yes"], "streaming_tv": ["Yes"], "streaming_movies": ["Yes"],
    "contract_type": ["One year", "Two year"], "paperless_billing": ["Yes"],
    "payment_method": ["Credit card (automatic)", "Electronic check", "Mailed check"],
}
_PASSED = ["is_autopay", "is_new_subscriber", "fibre_without_support", "has_protection_bundle", "contract_commitment_months"]
ORACLE["prepared_features"] = on(
    "features",
    "SELECT subscriber_id, "
    + ", ".join(
        [f"{away(f'(({c} - m_{c}) / s_{c})', 8)} AS scaled_{c}" for c in _SCALED]
        + [f"({c} = '{v}')::INT::DOUBLE AS {c}__{i}" for c, levels in _LEVELS.items() for i, v in enumerate(levels, 1)]
        + [f"{c}::DOUBLE AS {c}" for c in _PASSED]
    )
    + " FROM features, moments",
    moments="SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_samp({c}) AS s_{c}" for c in _SCALED)
    + f" FROM features WHERE {_split(1)} % 100 >= 20",
)

_SCORER = ["contract_type", "payment_method", "tenure_months", "monthly_charge"]


def _fixed_score(taken: str | None) -> str:
    """The fixed score of a row whose column ``taken`` comes from its donor."""
    c, p, t, m = (f"donor.{x}" if x == taken else x for x in _SCORER)
    return (
        f"(CASE {c} WHEN 'Month-to-month' THEN 4000 WHEN 'One year' THEN 2000 ELSE 500 END + CASE {p} WHEN 'Electronic check' "
        f"THEN 1500 ELSE 300 END + 20 * (100 - least({t}, 100)) + floor({m} * 10)::BIGINT) / 1e4"
    )


_auc = away("(sum(pos * (2 * below + neg)) / (2e0 * max(np) * max(nn)))", 10)
ORACLE["importance_of_fixed_scorer"] = on(
    "features",
    f"""SELECT feature, {away('avg(base.auc - a.auc)', 10)} AS importance_mean, {away('stddev_pop(base.auc - a.auc)', 10)} AS importance_std
      FROM aucs a, (SELECT auc FROM aucs WHERE repeat = 0) base WHERE repeat > 0 GROUP BY feature
      UNION ALL SELECT unnest({[c for c in [*_SCALED, *_LEVELS, *_PASSED] if c not in _SCORER]}), 0e0, 0e0""",
    dealt="""SELECT f.*, repeat, md5('42|' || repeat || '|' || subscriber_id) AS o,
      ('0x' || substr(md5('43|' || repeat || '|' || subscriber_id), 1, 8))::BIGINT
        % (SELECT greatest(1, count(*) // 100000) FROM features) AS bucket
      FROM features f, (SELECT unnest(range(1, 6)) AS repeat)""",
    paired=f"""SELECT *, coalesce(lead(own) OVER w, first_value(own) OVER w) AS donor
      FROM (SELECT *, {{{', '.join(f"'{x}': {x}" for x in _SCORER)}}} AS own FROM dealt)
      WINDOW w AS (PARTITION BY repeat, bucket ORDER BY o, subscriber_id)""",
    scored=" UNION ALL ".join(
        [f"SELECT '' AS feature, 0 AS repeat, churned_flag AS label, {_fixed_score(None)} AS score FROM features"]
        + [f"SELECT '{x}', repeat, churned_flag, {_fixed_score(x)} FROM paired" for x in _SCORER]
    ),
    cells="SELECT feature, repeat, score, sum(label) AS pos, sum(1 - label) AS neg FROM scored GROUP BY feature, repeat, score",
    placed="""SELECT *, sum(pos) OVER g AS np, sum(neg) OVER g AS nn, coalesce(sum(neg) OVER (PARTITION BY feature, repeat
      ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM cells
      WINDOW g AS (PARTITION BY feature, repeat)""",
    aucs=f"SELECT feature, repeat, {_auc} AS auc FROM placed GROUP BY feature, repeat",
)
ORACLE["class_weights"] = on(
    "features",
    "SELECT label, n_rows, n / (2e0 * n_rows) AS weight FROM sized, (SELECT sum(n_rows) AS n FROM sized)",
    sized=f"SELECT churned_flag AS label, count(*) AS n_rows FROM features WHERE {_split(1)} % 100 >= 20 GROUP BY churned_flag",
)
