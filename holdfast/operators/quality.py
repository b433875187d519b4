"""Validation of the raw table and constraint checks of the star schema, as rows of counts."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_even, ratio
from holdfast.sources.schema import (
    ALLOWED, CONTRACTS, CORRUPT, HEADER_OF, INTERNET, PREDICTION_KEY, RAW_COLUMNS, STAR, YES_NO,
)

REQUIRED = [raw for _, raw, _, _ in RAW_COLUMNS]
MAX_TENURE = 200  # Fixed value: highest plausible tenure in months.

_REPORT = "check string, status string, item string, measured double"


def _text(value: str) -> str:
    """SQL literal."""
    return "'" + value.replace("'", "\\'") + "'"


def _line(check: str, status: str, item: str = "NULL", measured: str = "NULL") -> str:
    """One report row as a SQL struct; the arguments are SQL expressions."""
    return (
        f"named_struct('check', CAST({check} AS STRING), 'status', {status}, 'item', CAST({item} AS STRING), "
        f"'measured', CAST({measured} AS DOUBLE))"
    )


def _status(ok: str, critical: bool = False) -> str:
    return f"IF({ok}, 'PASS', '{'FAIL_CRITICAL' if critical else 'FAIL_WARNING'}')"


def _outside(name: str) -> str:
    """Value outside the allowed set. A missing value counts only for the senior flag."""
    missing = "true" if name == "senior_citizen" else "false"
    return f"coalesce({name} NOT IN ({', '.join(_text(v) for v in ALLOWED[name])}), {missing})"


def duplicate_rows(df: DataFrame, keys: list[str]) -> DataFrame:
    """Rows beyond the first of each key, NULL keys taken as equal. Shuffles only the key, pre-counted per task."""
    return df.groupBy(*keys).agg(F.count("*").alias("n")).agg(
        F.coalesce(F.sum(F.col("n") - 1), F.lit(0)).alias("duplicates")
    )


def unexpected_values(raw: DataFrame) -> DataFrame:
    """Every value outside its column's allowed set, with its row count.

    Rows without any such value are dropped before the columns are fanned out.
    """
    pairs = ", ".join(
        f"named_struct('column_name', {_text(HEADER_OF[c])}, 'value', {c}, 'outside', {_outside(c)})" for c in ALLOWED
    )
    return (
        raw.filter(" OR ".join(_outside(c) for c in ALLOWED))
        .selectExpr(f"inline(array({pairs}))")
        .filter("outside")
        .groupBy("column_name", "value")
        .agg(F.count("*").alias("row_count"))
    )


def label_counts(raw: DataFrame) -> DataFrame:
    """Rows and share per label value."""
    total = raw.agg(F.count("*")).scalar()
    return (
        raw.filter(F.col("churn_label").isNotNull())
        .groupBy("churn_label")
        .agg(F.count("*").alias("row_count"))
        .withColumn("share", half_even(ratio(F.col("row_count"), total), 4))
    )


def validation_report(raw: DataFrame) -> DataFrame:
    """Checks on the raw table, one row per check or reported item.

    All counts except key uniqueness come from one aggregate pass without a shuffle. Key uniqueness is kept
    apart, since it shuffles the key and would drag every other count along. Missing columns are a fact of
    the schema: they end the report after one row.
    """
    spark = raw.sparkSession
    missing = [HEADER_OF[c] for c in REQUIRED if c not in raw.columns]
    if missing:
        line = (f"Required columns present (missing: {', '.join(missing)})", "FAIL_CRITICAL", None, float(len(missing)))
        return spark.createDataFrame([line], _REPORT)

    listed = [c for c in raw.columns if c != CORRUPT]
    measures = {
        "n": "count(*)",
        **({"malformed": f"count_if({CORRUPT} IS NOT NULL)"} if CORRUPT in raw.columns else {}),
        "tenure_ok": "coalesce(bool_and(coalesce(tenure_months >= 0, false)), true)",
        "tenure_bad": "count_if(tenure_months < 0)",
        "charge_ok": "coalesce(bool_and(coalesce(monthly_charges > 0, false)), true)",
        "charge_bad": "count_if(monthly_charges <= 0)",
        "tenure_max": "max(tenure_months)",
        "blank": "count_if(try_cast(total_charges AS DOUBLE) IS NULL)",
        "tenure_zero": "count_if(tenure_months = 0)",
        "yes": "count_if(churn_label = 'Yes')",
        **{f"out_{c}": f"count_if({_outside(c)})" for c in ALLOWED},
        **{f"null_{c}": f"count_if(`{c}` IS NULL)" for c in listed},
    }
    one = raw.agg(*[F.expr(f"{rule} AS `{name}`") for name, rule in measures.items()]).withColumn(
        "duplicates", duplicate_rows(raw, ["customer_id"]).scalar()
    )
    lines = [
        _line("'Required columns present (missing: none)'", "'PASS'", measured="0"),
        _line(
            "concat('CustomerID uniqueness (duplicates: ', duplicates, ')')",
            _status("duplicates = 0", critical=True),
            measured="duplicates",
        ),
    ]
    for name in ALLOWED:
        n = f"out_{name}"
        label = f"Allowed values for '{HEADER_OF[name]}' (unexpected: "
        found = f"IF({n} = 0, 'none', concat({n}, ' rows'))"
        lines.append(_line(f"concat({_text(label)}, {found}, ')')", _status(f"{n} = 0"), measured=n))
    for label, name in (("Tenure Months >= 0", "tenure"), ("Monthly Charges > 0", "charge")):
        lines.append(
            _line(
                f"concat('{label} (violations: ', {name}_bad, ')')",
                _status(f"{name}_ok", critical=True),
                measured=f"{name}_bad",
            )
        )
    lines += [
        _line(
            f"'Tenure Months max reasonable (<= {MAX_TENURE} months)'",
            _status(f"coalesce(tenure_max <= {MAX_TENURE}, false)"),
            measured="tenure_max",
        ),
        _line(
            "concat('Total Charges blanks (', blank, ') match Tenure=0 rows (', tenure_zero, ')')",
            _status("blank = tenure_zero"),
            measured="blank",
        ),
        *[
            _line("'Missingness report'", "'INFO'", _text(HEADER_OF.get(name, name.replace("_", " ").title())), f"`null_{name}`")
            for name in listed
        ],
    ]
    if CORRUPT in raw.columns:
        lines.append(_line("concat('Well-formed rows (malformed: ', malformed, ')')", _status("malformed = 0"), measured="malformed"))
    share = half_even(ratio(F.col("yes"), F.col("n")), 4)
    lines.append(_line("'Target distribution'", "'INFO'", "'churn_rate'", "share"))
    report = (
        one.withColumn("share", share)
        .selectExpr(f"inline(array({', '.join(lines)}))")
        .filter("check <> 'Missingness report' OR measured > 0")
    )
    labels = label_counts(raw).selectExpr(
        f"inline(array({_line(_text('Target distribution'), _text('INFO'), 'churn_label', 'row_count')}))"
    )
    return report.unionByName(labels)


def validation_document(raw: DataFrame) -> DataFrame:
    """The report as one nested record: a list of findings, each with a map of its reported items."""
    size = raw.agg(F.count("*").alias("row_count"))
    item = F.when(F.col("item").isNotNull(), F.struct("item", "measured"))
    findings = (
        validation_report(raw)
        .groupBy("check", "status")
        .agg(F.map_from_entries(F.array_sort(F.collect_list(item))).alias("details"))
        .agg(F.collect_list(F.struct("check", "status", "details")).alias("findings"))
    )
    return findings.select(
        size.scalar().alias("row_count"), F.lit(len(raw.columns)).cast("bigint").alias("column_count"), "findings"
    )


# Constraint catalogue -----------------------------------------------------------------------------------

# Rules per table. Every listed column must be non-null; PK and FK follow below.
BANDS = ["High", "Medium", "Low"]
ENUMS = {
    "dim_subscriber": {"gender": ["Male", "Female"], "is_senior": YES_NO, "has_partner": YES_NO, "has_dependents": YES_NO},
    "dim_service_profile": {
        "phone_service": YES_NO, "multiple_lines": YES_NO, "internet_service": INTERNET, "online_security": YES_NO,
        "online_backup": YES_NO, "device_protection": YES_NO, "tech_support": YES_NO, "streaming_tv": YES_NO,
        "streaming_movies": YES_NO,
    },
    "dim_contract": {"contract_type": CONTRACTS, "paperless_billing": YES_NO},
    "fact_prediction": {"risk_band": BANDS},
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
    "fact_prediction": {"risk_score": "risk_score BETWEEN 0.0D AND 1.0D"},
}
PRIMARY_KEYS = {
    **{name: ["subscriber_id"] for name in STAR}, "fact_prediction": PREDICTION_KEY, "model_run": ["run_id"],
}
REQUIRED_IN_REGISTRY = ["run_id", "model_name", "trained_at", "seed"]
PARENT = "dim_subscriber"
CHILDREN = [*[name for name in STAR if name != PARENT], "fact_prediction"]


def _row_rules(name: str, columns: list[str]) -> list[tuple[str, str, str]]:
    """(kind, column, condition of a violation) of the rules one row can break. A NULL breaks only its
    not-null rule."""
    required = REQUIRED_IN_REGISTRY if name == "model_run" else columns
    rules = [("not_null", c, f"{c} IS NULL") for c in required]
    for kind, domains in (("enum", ENUMS), ("code", CODES)):
        for c, values in domains.get(name, {}).items():
            listed = ", ".join(_text(v) if isinstance(v, str) else str(v) for v in values)
            rules.append((kind, c, f"{c} NOT IN ({listed})"))
    rules += [("range", c, f"NOT ({rule})") for c, rule in RANGES.get(name, {}).items()]
    return rules


def _violations(counts: DataFrame, name: str, lines: list[tuple[str, str, str]]) -> DataFrame:
    """Rows (table, kind, column, violations) from one row of counts."""
    structs = ", ".join(
        f"named_struct('table_name', '{name}', 'rule_kind', '{kind}', 'column_name', '{column}', "
        f"'violations', CAST({count} AS BIGINT))"
        for kind, column, count in lines
    )
    return counts.selectExpr(f"inline(array({structs}))")


def constraint_violations(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows violating each declared rule, per table.

    One pass per table: its rows are looked up in the parent's keys and grouped by their own key, both within the
    buckets of a stored table, so neither moves rows; rule hits, copies and orphans are summed from the groups. A key
    that is NULL in any part is neither a copy nor an orphan.
    """
    parts = []
    parent = tables[PARENT].groupBy("subscriber_id").agg(F.lit(True).alias("_known"))
    for name, df in tables.items():
        key, rules = PRIMARY_KEYS[name], _row_rules(name, df.columns)
        lines = [(kind, c, f"r{i}") for i, (kind, c, _) in enumerate(rules)] + [("primary_key", ",".join(key), "copies")]
        sums = [F.expr(f"count_if({broken}) AS r{i}") for i, (_, _, broken) in enumerate(rules)]
        if name in CHILDREN:
            df = df.join(parent, "subscriber_id", "left")
            sums.append(F.count_if(F.col("_known").isNull() & F.col("subscriber_id").isNotNull()).alias("orphans"))
            lines.append(("foreign_key", "subscriber_id", "orphans"))
        complete = reduce(Column.__and__, [F.col(c).isNotNull() for c in key])
        per_key = df.groupBy(*key).agg(*sums, F.count("*").alias("n")).withColumn("copies", F.when(complete, F.col("n") - 1))
        counts = per_key.agg(*[F.coalesce(F.sum(c), F.lit(0)).alias(c) for _, _, c in lines])
        parts.append(_violations(counts, name, lines))
    return reduce(DataFrame.unionByName, parts)


def assert_constraints(tables: dict[str, DataFrame]) -> None:
    """Raise with the broken rules, if any. Only the rule rows (about 80) reach the driver."""
    broken = constraint_violations(tables).filter("violations > 0").collect()
    if broken:
        raise ValueError("; ".join(f"{r.table_name}.{r.column_name} {r.rule_kind}: {r.violations}" for r in broken))
