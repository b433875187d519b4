"""The refresh chain: gate, stored scores, applied cut-offs, kept history."""

import pytest
from pyspark.sql import functions as F

from holdfast.plans import refresh, reports
from holdfast.sources.schema import RAW_COLUMNS

SMALL_FIT = {"trees": 5, "tree_depth": 3, "rounds": 2}


def _csv(raw, path, rows=None):
    headers = {name: header for header, name, _, _ in RAW_COLUMNS}
    table = raw if rows is None else rows
    table.select(*[F.col(c).alias(headers.get(c, c)) for c in table.columns]).coalesce(1).write.option("header", True).csv(path)


def test_refresh(spark, raw, tmp_path):
    _csv(raw, f"{tmp_path}/csv")
    wh = refresh.refresh(spark, f"{tmp_path}/csv", f"{tmp_path}/landing", "holdfast_refresh", "2026-03-01T00:00:00Z", **SMALL_FIT)
    predictions = wh.table("fact_prediction")
    assert predictions.count() == 6 * 150 and wh.table("model_run").count() == 6
    preferred = wh.watchlist_scores()
    assert {r.model_name for r in preferred.select("model_name").distinct().collect()} == {"xgb_calibrated"}
    cut = refresh.optimal_threshold(wh).join(preferred.select("run_id").distinct(), "run_id").first()
    wrong = preferred.filter((F.col("risk_score") >= cut.high_cutoff) != (F.col("risk_band") == "High"))
    assert wrong.count() == 0
    bands = {r.risk_band for r in preferred.select("risk_band").distinct().collect()}
    assert {r.risk_band for r in reports.revenue_at_risk_by_band(wh).select("risk_band").collect()} == bands
    refresh.train_and_store(wh, "2026-03-02T00:00:00Z", **SMALL_FIT)
    assert wh.table("model_run").count() == 12 and wh.table("fact_prediction").count() == 12 * 150
    kept = wh.table("fact_prediction").join(predictions.select("run_id").distinct(), "run_id", "left_semi")
    assert kept.count() >= 6 * 150


def test_a_bad_row_stops_the_load(spark, raw):
    negative = raw.withColumn("tenure_months", F.when(F.col("customer_id") == "S1", F.lit(-1)).otherwise(F.col("tenure_months")))
    with pytest.raises(ValueError, match="Tenure Months >= 0"):
        refresh.load(spark, negative, "holdfast_bad")
    with pytest.raises(ValueError, match="uniqueness"):
        refresh.load(spark, raw.unionByName(raw.limit(1)), "holdfast_bad")
    unknown = raw.withColumn("contract", F.when(F.col("customer_id") == "S1", F.lit("Weekly")).otherwise(F.col("contract")))
    with pytest.raises(ValueError, match="contract_type enum"):
        refresh.load(spark, unknown, "holdfast_bad")
