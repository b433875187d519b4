"""Injected faults are reported, each once."""

from pyspark.sql import functions as F

from holdfast.operators.clean import clean, cleaning_log
from holdfast.operators.features import add_features
from holdfast.operators.keyed import first_per_key, upsert
from holdfast.operators.quality import (
    assert_constraints, constraint_violations, unexpected_values, validation_document, validation_report,
)
from holdfast.plans.warehouse import TABLES
from holdfast.sources.fixture import faulty_star


def _with(raw, **changes):
    """The raw table plus one copy of a row under a new id with some columns changed."""
    row = raw.filter("tenure_months > 0").orderBy("customer_id").limit(1)
    row = row.withColumn("customer_id", F.lit("S999999"))
    for name, value in changes.items():
        row = row.withColumn(name, F.lit(value).cast(dict(raw.dtypes)[name]))
    return raw.unionByName(row)


def _failed(report):
    return {(r.check.split(" (")[0], r.status) for r in report.filter("status LIKE 'FAIL%'").collect()}


def test_raw_faults(raw):
    cases = [
        ({"gender": "X"}, {("Allowed values for 'Gender'", "FAIL_WARNING")}),
        ({"contract": "Weekly"}, {("Allowed values for 'Contract'", "FAIL_WARNING")}),
        ({"tenure_months": -1}, {("Tenure Months >= 0", "FAIL_CRITICAL")}),
        ({"tenure_months": 201}, {("Tenure Months max reasonable", "FAIL_WARNING")}),
        ({"monthly_charges": 0.0}, {("Monthly Charges > 0", "FAIL_CRITICAL")}),
        ({"total_charges": " "}, {("Total Charges blanks", "FAIL_WARNING")}),
        ({"total_charges": "abc"}, {("Total Charges blanks", "FAIL_WARNING")}),
        ({"churn_label": "Maybe"}, {("Allowed values for 'Churn Label'", "FAIL_WARNING")}),
    ]
    assert _failed(validation_report(raw)) == set()
    for changes, expected in cases:
        assert _failed(validation_report(_with(raw, **changes))) == expected, changes


def test_duplicate_and_missing_ids(raw):
    twice = raw.unionByName(raw.filter("customer_id = 'S1'"))
    assert _failed(validation_report(twice)) == {("CustomerID uniqueness", "FAIL_CRITICAL")}
    row = validation_report(raw.drop("gender")).collect()
    assert [(r.check, r.status) for r in row] == [("Required columns present (missing: Gender)", "FAIL_CRITICAL")]


def test_unexpected_values_are_listed(raw):
    bad = _with(raw, gender="X", contract="Weekly")
    assert {tuple(r) for r in unexpected_values(bad).collect()} == {("Gender", "X", 1), ("Contract", "Weekly", 1)}


def test_validation_document_nests_the_findings(raw):
    doc = validation_document(raw).first()
    details = {f.check: f.details for f in doc.findings}
    assert doc.row_count == 150 and doc.column_count == 22
    assert details["Missingness report"] == {"Churn Reason": 81.0}
    assert set(details["Target distribution"]) == {"Yes", "No", "churn_rate"}


def test_blank_total_with_tenure_stays_missing(raw):
    bad = _with(raw, total_charges=" ")
    row = clean(bad).filter("subscriber_id = 'S999999'").first()
    assert row.lifetime_billed is None
    zero = clean(raw).filter("tenure_months = 0")
    assert zero.count() == zero.filter("lifetime_billed = 0").count() == 3


def test_coded_senior_flag(raw):
    coded = raw.withColumn("senior_citizen", F.when(F.col("senior_citizen") == "Yes", 1).otherwise(0))
    assert cleaning_log(coded).count() == 11
    assert sorted(clean(coded).collect()) == sorted(clean(raw).collect())


def test_tenure_bands(spark):
    from holdfast.operators.features import tenure_band

    values = [-1, 0, 6, 7, 12, 13, 24, 25, 48, 49, 72, 73]
    got = spark.createDataFrame([(v,) for v in values], "t bigint").select(tenure_band(F.col("t"))).collect()
    assert [r[0] for r in got] == [
        "nan", "0–6 mo", "0–6 mo", "7–12 mo", "7–12 mo", "13–24 mo", "13–24 mo", "25–48 mo", "25–48 mo",
        "49–72 mo", "49–72 mo", "73+ mo",
    ]


def test_constraint_faults(wh):
    tables = {name: wh.table(name) for name in TABLES}
    assert_constraints(tables)
    p = tables["fact_prediction"]
    one = p.filter("run_id = 'r1' AND subscriber_id = 'S1'")
    tables["fact_prediction"] = p.unionByName(one).unionByName(
        one.withColumn("subscriber_id", F.lit("ghost")).withColumn("risk_score", F.lit(1.2))
    )
    tables["fact_billing"] = tables["fact_billing"].withColumn(
        "monthly_charge", F.when(F.col("subscriber_id") == "S1", 0.0).otherwise(F.col("monthly_charge"))
    )
    broken = {tuple(r) for r in constraint_violations(tables).filter("violations > 0").collect()}
    assert broken == {
        ("fact_prediction", "primary_key", "run_id,subscriber_id,model_name", 1),
        ("fact_prediction", "foreign_key", "subscriber_id", 1),
        ("fact_prediction", "range", "risk_score", 1),
        ("fact_billing", "range", "monthly_charge", 1),
    }


def test_first_per_key_is_whole_and_deterministic(spark):
    rows = [("hot", i, str(i)) for i in range(500)] + [("a", 1, "x"), (None, 1, "n"), (None, 2, "m")]
    df = spark.createDataFrame(rows, "k string, v int, w string")
    got = {tuple(r) for r in first_per_key(df.repartition(7), ["k"]).collect()}
    assert got == {("hot", 0, "0"), ("a", 1, "x"), (None, 1, "n")}


def test_upsert_replaces_and_adds(spark):
    old = spark.createDataFrame([("a", 1), ("b", 2)], "k string, v int")
    new = spark.createDataFrame([("b", 9), ("b", 7), ("c", 3)], "k string, v int")
    assert sorted(map(tuple, upsert(old, new, ["k"], [F.desc("v")]).collect())) == [("a", 1), ("b", 9), ("c", 3)]


def test_features_match_their_count(raw):
    assert len(add_features(clean(raw)).columns) == 30


def test_malformed_csv_rows_are_counted(spark, raw, tmp_path):
    from holdfast.operators.quality import validation_report
    from holdfast.sources.schema import RAW_COLUMNS
    from holdfast.sources.tables import land

    rows = raw.limit(3).collect()
    names = [name for _, name, _, _ in RAW_COLUMNS]
    lines = [",".join(header for header, _, _, _ in RAW_COLUMNS)] + [",".join(str(r[n]) for n in names) for r in rows]
    lines += [lines[1] + ",surplus", ",".join(lines[2].split(",")[:4])]
    (tmp_path / "a.csv").write_text("\n".join(lines))
    landed = land(spark, f"{tmp_path}/a.csv", f"{tmp_path}/landed")
    assert landed.where("corrupt_record IS NOT NULL").count() == 2
    report = {r["check"]: r for r in validation_report(landed).collect()}
    assert report["Well-formed rows (malformed: 2)"].status == "FAIL_WARNING"
    assert not any(r.item == "Corrupt Record" for r in report.values())


def test_every_rule_kind_is_broken_by_the_faulty_star(wh):
    rows = constraint_violations(faulty_star({name: wh.table(name) for name in TABLES})).collect()
    broken = {(r.table_name, r.rule_kind) for r in rows if r.violations > 0}
    assert {kind for _, kind in broken} == {"not_null", "enum", "code", "range", "primary_key", "foreign_key"}
    assert {("dim_contract", "foreign_key"), ("dim_subscriber", "primary_key"), ("fact_prediction", "range")} <= broken


def test_a_null_key_breaks_only_its_not_null_rule(wh):
    tables = {name: wh.table(name) for name in TABLES}
    blank = tables["dim_contract"].withColumn("subscriber_id", F.lit(None).cast("string"))
    rows = constraint_violations({**tables, "dim_contract": blank}).filter("table_name = 'dim_contract'").collect()
    assert {(r.rule_kind, r.column_name): r.violations for r in rows if r.violations} == {("not_null", "subscriber_id"): 150}
