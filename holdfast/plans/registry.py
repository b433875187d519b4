"""Named queries: name -> callable(spark, data folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators import quality
from holdfast.operators.clean import clean, cleaning_log
from holdfast.operators.features import add_features
from holdfast.operators.keyed import first_per_key, latest_calibrated_run, of_run, upsert
from holdfast.plans import contingency, metrics, numeric, odds, reports, survival, training, watchlist
from holdfast.plans.warehouse import KEY, STAR, TABLES, Warehouse, open_warehouse
from holdfast.sources.fixture import faulty_star, faulty_subscribers, raw_subscribers
from holdfast.sources.schema import PREDICTION_KEY
from holdfast.sources.tables import fingerprint, profile

Query = Callable[[SparkSession, str], DataFrame]


def _on_raw(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(raw_subscribers(spark, folder))


def _on_faulty(plan: Callable[[DataFrame], DataFrame]) -> Query:
    return lambda spark, folder: plan(faulty_subscribers(spark, folder))


def _on_warehouse(plan: Callable[[Warehouse], DataFrame]) -> Query:
    return lambda spark, folder: plan(open_warehouse(spark, folder))


def _on_tables(plan: Callable[[dict[str, DataFrame]], DataFrame]) -> Query:
    return _on_warehouse(lambda wh: plan({name: wh.table(name) for name in TABLES}))


def _rescored(wh: Warehouse) -> DataFrame:
    """Upsert of a second scoring of the newest calibrated run, five points higher, into the stored rows."""
    stored = wh.table("fact_prediction")
    score = F.rint(F.least(F.lit(0.9999), F.col("risk_score") + 0.05) * 1e4) / 1e4
    again = of_run(stored, latest_calibrated_run(wh.table("model_run"))).withColumn("risk_score", score)
    return upsert(stored, again, PREDICTION_KEY).select("run_id", "subscriber_id", "model_name", "risk_score")


QUERIES: dict[str, Query] = {
    # raw table: cleaning, features, quality
    "cleaned_subscribers": _on_raw(clean),
    "features": _on_raw(lambda raw: add_features(clean(raw))),
    "cleaning_log": _on_raw(cleaning_log),
    "validation_report": _on_raw(quality.validation_report),
    "unexpected_values": _on_raw(quality.unexpected_values),
    "label_counts": _on_raw(quality.label_counts),
    "table_profile": _on_raw(profile),
    "table_fingerprint": _on_raw(fingerprint),
    # the same over a table with faults
    "cleaned_subscribers_faulty": _on_faulty(clean),
    "cleaning_log_faulty": _on_faulty(cleaning_log),
    "validation_report_faulty": _on_faulty(quality.validation_report),
    "unexpected_values_faulty": _on_faulty(quality.unexpected_values),
    "label_counts_faulty": _on_faulty(quality.label_counts),
    "table_fingerprint_faulty": _on_faulty(fingerprint),
    "deduplicated_features_faulty": _on_faulty(lambda raw: first_per_key(add_features(clean(raw)), [KEY])),
    # star schema
    **{name: _on_warehouse(lambda wh, name=name: wh.table(name)) for name in STAR},
    "subscriber_360": _on_warehouse(Warehouse.subscriber_360),
    "scored_watchlist": _on_warehouse(Warehouse.scored_watchlist),
    "constraint_violations": _on_tables(quality.constraint_violations),
    "constraint_violations_faulty": _on_tables(lambda tables: quality.constraint_violations(faulty_star(tables))),
    "predictions_upsert": _on_warehouse(_rescored),
    # reports
    "kpi_summary": _on_warehouse(reports.kpi_summary),
    "attrition_by_contract_and_tenure": _on_warehouse(reports.attrition_by_contract_and_tenure),
    "payment_method_attrition": _on_warehouse(reports.payment_method_attrition),
    "services_count_vs_attrition": _on_warehouse(reports.services_count_vs_attrition),
    "segment_lift": _on_warehouse(reports.segment_lift),
    "tenure_cohort_retention": _on_warehouse(reports.tenure_cohort_retention),
    "revenue_at_risk_by_band": _on_warehouse(reports.revenue_at_risk_by_band),
    "top_risk_within_segment": _on_warehouse(reports.top_risk_within_segment),
    "data_quality_checks": _on_tables(reports.data_quality_checks),
    "data_quality_checks_faulty": _on_tables(lambda tables: reports.data_quality_checks(faulty_star(tables))),
    "table_row_counts": _on_warehouse(reports.table_row_counts),
    "command_center_kpis": _on_warehouse(reports.command_center_kpis),
    "churn_rate_by_contract": _on_warehouse(reports.churn_rate_by_contract),
    "churn_rate_by_payment": _on_warehouse(reports.churn_rate_by_payment),
    "churn_rate_by_internet": _on_warehouse(reports.churn_rate_by_internet),
    "services_stickiness": _on_warehouse(reports.services_stickiness),
    "contract_tenure_heatmap": _on_warehouse(reports.contract_tenure_heatmap),
    "severity_cluster": _on_warehouse(reports.severity_cluster),
    "highest_charges": _on_warehouse(reports.highest_charges),
    "insights_revenue_at_risk": _on_warehouse(reports.insights_revenue_at_risk),
    "insights_contract": _on_warehouse(reports.insights_contract),
    # watchlist and planner
    "top_risk_preview": _on_warehouse(watchlist.top_risk_preview),
    "call_list": _on_warehouse(watchlist.call_list),
    "watchlist_page": _on_warehouse(lambda wh: watchlist.watchlist_page(wh, page=3)),
    "watchlist_deep_page": _on_warehouse(lambda wh: watchlist.watchlist_page(wh, page=200)),
    "watchlist_page_beyond": _on_warehouse(lambda wh: watchlist.watchlist_page(wh, page=10**6)),
    "watchlist_kpi": _on_warehouse(watchlist.watchlist_kpi),
    "watchlist_detail": _on_warehouse(lambda wh: watchlist.watchlist_detail(wh, "S1")),
    "retention_plan": _on_warehouse(watchlist.retention_plan),
    "retention_plan_grid": _on_warehouse(watchlist.retention_plan_grid),
    "retention_value_grid": _on_warehouse(lambda wh: watchlist.retention_plan_grid(wh, mode="assumption")),
    "model_leaderboard": _on_warehouse(watchlist.model_leaderboard),
    # model quality
    "classification_metrics": _on_warehouse(metrics.classification_metrics),
    "optimal_threshold": _on_warehouse(metrics.optimal_threshold),
    # statistics
    "association_tests": _on_warehouse(contingency.association_tests),
    "numeric_tests": _on_warehouse(numeric.numeric_tests),
    "bootstrap_intervals": _on_warehouse(numeric.bootstrap_intervals),
    "odds_ratios": _on_warehouse(odds.odds_ratios),
    "gram_matrix": _on_warehouse(odds.gram_matrix),
    "vif": _on_warehouse(odds.vif),
    "km_curves": _on_warehouse(survival.km_curves),
    "km_summary": _on_warehouse(survival.km_summary),
    # training: what has one right answer, then the iterative fits
    "training_split": _on_warehouse(lambda wh: training.model_rows(wh).select(KEY, "held_out", "fold", "label")),
    "class_weights": _on_warehouse(training.class_weights),
    "calibration_curves": _on_warehouse(training.calibration_curves),
    "prepared_features": _on_warehouse(training.prepared_features),
    "importance_of_fixed_scorer": _on_warehouse(training.importance_of_fixed_scorer),
    "trained_models": _on_warehouse(training.trained_runs),
    "train_and_score": _on_warehouse(training.train_and_score),
    "feature_importance": _on_warehouse(training.feature_importance),
}


def run_query(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """Run a named query; an unknown name is an error that lists the known ones."""
    if name not in QUERIES:
        raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(QUERIES))}")
    return QUERIES[name](spark, folder)
