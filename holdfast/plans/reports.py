"""Attrition, revenue and cohort reports over the star tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_away, half_even, money_avg, money_sum, product_sum, ratio
from holdfast.operators.keyed import latest_calibrated_run, of_run
from holdfast.plans.warehouse import KEY, Warehouse
from holdfast.sources.schema import STAR

MIN_CELL = 50  # Fixed value: smallest cell a rate is reported for.
TOP_IN_SEGMENT = 20  # Fixed value: rows kept per contract.

CHURNED = "churned_flag"


def _rate(digits: int = 4) -> Column:
    return half_away(ratio(F.sum(CHURNED), F.count("*")), digits)


def _counts() -> list[Column]:
    return [F.count("*").alias("subscriber_count"), F.sum(CHURNED).alias("churned_count")]


def kpi_summary(wh: Warehouse) -> DataFrame:
    """Ten top-line figures in one global aggregate."""
    charge, gone = F.col("monthly_charge"), F.col(CHURNED) == 1
    return wh.star("dim_subscriber", "fact_billing", "fact_attrition_label").agg(
        F.count("*").alias("total_subscribers"),
        F.sum(CHURNED).alias("churned_count"),
        (F.count("*") - F.sum(CHURNED)).alias("retained_count"),
        _rate().alias("attrition_rate"),
        half_away(money_sum(charge), 2).alias("total_mrr"),
        half_away(money_sum(F.when(gone, charge).otherwise(0)), 2).alias("mrr_lost_to_churn"),
        half_away(F.avg("tenure_months"), 2).alias("avg_tenure_months"),
        half_away(money_avg(charge), 2).alias("avg_monthly_charge"),
        half_away(money_avg(F.when(gone, charge)), 2).alias("arpu_churned"),
        half_away(money_avg(F.when(F.col(CHURNED) == 0, charge)), 2).alias("arpu_retained"),
    )


def attrition_by_contract_and_tenure(wh: Warehouse, min_cell: int = MIN_CELL) -> DataFrame:
    return (
        wh.star("dim_subscriber", "dim_contract", "fact_attrition_label")
        .groupBy("contract_type", "tenure_band")
        .agg(*_counts(), _rate().alias("attrition_rate"))
        .filter(F.col("subscriber_count") >= min_cell)
        .orderBy("contract_type", F.desc("attrition_rate"))
    )


def _rate_and_charge(joined: DataFrame, *keys: str) -> DataFrame:
    return joined.groupBy(*keys).agg(
        *_counts(),
        _rate().alias("attrition_rate"),
        half_away(money_avg(F.col("monthly_charge")), 2).alias("avg_monthly_charge"),
    )


def payment_method_attrition(wh: Warehouse) -> DataFrame:
    joined = wh.star("dim_contract", "fact_attrition_label", "fact_billing")
    return _rate_and_charge(joined, "payment_method", "is_autopay").orderBy(F.desc("attrition_rate"))


def services_count_vs_attrition(wh: Warehouse) -> DataFrame:
    joined = wh.star("dim_service_profile", "fact_attrition_label", "fact_billing")
    return _rate_and_charge(joined, "services_count").orderBy("services_count")


# Dimension tag per segment column.
SEGMENTS = {
    "contract_type": "Contract",
    "internet_service": "Internet Service",
    "payment_method": "Payment Method",
    "is_senior": "Senior Citizen",
}


def segment_lift(wh: Warehouse, min_cell: int = MIN_CELL) -> DataFrame:
    """Rate of each segment against the base rate.

    The rows are first counted per combination of the four dimensions (at most a few dozen groups), and
    only those groups are expanded into the four groupings, so the big tables are read once.
    """
    cells = (
        wh.star("dim_contract", "dim_service_profile", "dim_subscriber", "fact_attrition_label")
        .groupBy(*SEGMENTS)
        .agg(F.count("*").alias("n"), F.sum(CHURNED).alias("k"))
    )
    tagged = F.array(
        *[
            F.struct(F.lit(tag).alias("segment_dimension"), F.col(c).alias("segment_value"))
            for c, tag in SEGMENTS.items()
        ]
    )
    segments = (
        cells.select(F.inline(tagged), "n", "k")
        .groupBy("segment_dimension", "segment_value")
        .agg(F.sum("n").alias("subscriber_count"), F.sum("k").alias("churned_count"))
    )
    base = wh.table("fact_attrition_label").agg(_rate(6).alias("base_rate"))
    rate = half_away(ratio(F.col("churned_count"), F.col("subscriber_count")), 4)
    return (
        segments.filter(F.col("subscriber_count") >= min_cell)
        .withColumn("attrition_rate", rate)
        .withColumn("base_rate", base.scalar())
        .withColumn("lift_vs_base", half_away(ratio(F.col("attrition_rate"), F.col("base_rate")), 3))
        .orderBy(F.desc("lift_vs_base"))
    )


def tenure_cohort_retention(wh: Warehouse) -> DataFrame:
    """Share of all subscribers still active at or beyond each tenure.

    The running sum is over one row per tenure month, not over subscribers.
    """
    active = (
        wh.star("dim_subscriber", "fact_attrition_label")
        .filter(F.col(CHURNED) == 0)
        .groupBy("tenure_months")
        .agg(F.count("*").alias("subscribers_at_tenure"))
    )
    total = wh.table("dim_subscriber").agg(F.count("*"))
    longer = W.orderBy(F.desc("tenure_months")).rangeBetween(W.unboundedPreceding, W.currentRow)
    return (
        active.withColumn("total_subscribers", total.scalar())
        .withColumn(
            "cumulative_share_retained",
            half_away(ratio(F.sum("subscribers_at_tenure").over(longer), F.col("total_subscribers")), 4),
        )
        .orderBy("tenure_months")
    )


def _calibrated_with(wh: Warehouse, *tables: str) -> DataFrame:
    scores = of_run(wh.table("fact_prediction"), latest_calibrated_run(wh.table("model_run")))
    return scores.join(wh.star(*tables), KEY)


def _at_risk(scores: DataFrame) -> DataFrame:
    return scores.filter(F.col("risk_band").isin("High", "Medium"))


def revenue_at_risk_by_band(wh: Warehouse) -> DataFrame:
    """Revenue of the High and Medium bands of the newest calibrated run.

    The key of a prediction makes subscribers unique within one run and model, so counting them per band
    needs the distinct step only to guard against two models under one run id.
    """
    order = F.when(F.col("risk_band") == "High", 1).when(F.col("risk_band") == "Medium", 2).otherwise(3)
    charge, score = F.col("monthly_charge"), F.col("risk_score")
    return (
        _at_risk(_calibrated_with(wh, "fact_billing"))
        .groupBy("risk_band")
        .agg(
            F.count_distinct(KEY).alias("subscriber_count"),
            half_away(ratio(F.sum(score.cast("decimal(28,8)")), F.count("*")), 4).alias("avg_risk_score"),
            half_away(money_sum(charge), 2).alias("total_mrr_in_band"),
            half_away(product_sum(charge, score), 2).alias("revenue_at_risk"),
            half_away(money_avg(charge), 2).alias("avg_monthly_charge"),
        )
        .orderBy(order)
    )


def top_risk_within_segment(wh: Warehouse, top: int = TOP_IN_SEGMENT) -> DataFrame:
    """Highest-risk subscribers per contract. Each task keeps its own top rows per contract before the
    exchange (WindowGroupLimit), so a contract with a third of all rows moves only those. The remaining
    columns are joined to the winners only."""
    rank = F.row_number().over(W.partitionBy("contract_type").orderBy(F.desc("risk_score"), KEY))
    ranked = (
        _calibrated_with(wh, "dim_contract")
        .withColumn("rank_in_segment", rank)
        .filter(F.col("rank_in_segment") <= top)
        .select("contract_type", "rank_in_segment", KEY, "risk_score", "risk_band")
    )
    return (
        ranked.join(wh.table("fact_billing").select(KEY, "monthly_charge"), KEY)
        .join(wh.table("dim_subscriber").select(KEY, "tenure_months"), KEY)
        .select(
            "contract_type", "rank_in_segment", KEY, "risk_score", "risk_band", "monthly_charge", "tenure_months"
        )
        .orderBy("contract_type", "rank_in_segment")
    )


def data_quality_checks(tables: dict[str, DataFrame]) -> DataFrame:
    """Rows and missing ids per star table."""
    checks = [
        tables[name].agg(
            F.lit(name).alias("table_name"),
            F.count("*").alias("row_count"),
            F.count_if(F.col(KEY).isNull()).alias("null_id_count"),
        )
        for name in STAR
    ]
    return reduce(DataFrame.unionByName, checks)


def table_row_counts(wh: Warehouse) -> DataFrame:
    """Rows per star table and in total."""
    counts = reduce(
        DataFrame.unionByName,
        [wh.table(n).agg(F.lit(n).alias("table_name"), F.count("*").alias("row_count")) for n in STAR],
    )
    return counts.rollup("table_name").agg(F.sum("row_count").alias("row_count")).select(
        F.coalesce("table_name", F.lit("total_records")).alias("table_name"), "row_count"
    )


# Command-centre and segment-explorer tables ------------------------------------------------------------


def command_center_kpis(wh: Warehouse) -> DataFrame:
    charge = F.col("monthly_charge")
    listed = wh.watchlist_scores().agg(F.count("*"))
    return (
        wh.star("fact_billing", "fact_attrition_label")
        .agg(
            F.count("*").alias("total_subscribers"),
            half_even(ratio(F.sum(CHURNED), F.count("*")) * 100, 1).alias("churn_rate"),
            half_even(money_sum(charge), 2).alias("mrr"),
            half_even(money_sum(F.when(F.col(CHURNED) == 1, charge).otherwise(0)), 2).alias("churned_mrr"),
        )
        .withColumn("watchlist_count", listed.scalar())
    )


def churn_rate_by(wh: Warehouse, table: str, *keys: str) -> DataFrame:
    """Churn percentage and size of each group of one dimension table."""
    return (
        wh.star(table, "fact_attrition_label")
        .groupBy(*keys)
        .agg(
            half_away(ratio(F.sum(CHURNED), F.count("*")) * 100, 1).alias("churn_rate"),
            F.count("*").alias("count"),
        )
    )


def churn_rate_by_contract(wh: Warehouse) -> DataFrame:
    return churn_rate_by(wh, "dim_contract", "contract_type").orderBy(F.desc("churn_rate"))


def churn_rate_by_payment(wh: Warehouse) -> DataFrame:
    return churn_rate_by(wh, "dim_contract", "payment_method").orderBy(F.desc("churn_rate"))


def churn_rate_by_internet(wh: Warehouse) -> DataFrame:
    return churn_rate_by(wh, "dim_service_profile", "internet_service").orderBy(F.desc("churn_rate"))


def services_stickiness(wh: Warehouse) -> DataFrame:
    return churn_rate_by(wh, "dim_service_profile", "services_count").orderBy("services_count")


def contract_tenure_heatmap(wh: Warehouse) -> DataFrame:
    return (
        wh.star("dim_contract", "dim_subscriber", "fact_attrition_label")
        .groupBy("contract_type", "tenure_band")
        .agg(
            half_away(ratio(F.sum(CHURNED), F.count("*")) * 100, 1).alias("churn_rate"),
            F.count("*").alias("count"),
        )
        .orderBy("contract_type", "tenure_band")
    )


def severity_cluster(wh: Warehouse) -> DataFrame:
    """Size and quarterly revenue of month-to-month fibre subscribers in their first year."""
    return (
        wh.star("dim_contract", "dim_service_profile", "dim_subscriber", "fact_billing")
        .filter(
            (F.col("contract_type") == "Month-to-month")
            & (F.col("internet_service") == "Fiber optic")
            & (F.col("tenure_months") <= 12)
        )
        .agg(
            F.count("*").alias("count"),
            half_away(money_sum(F.col("monthly_charge")) * 3, 2).alias("quarterly_revenue"),
        )
    )


def highest_charges(wh: Warehouse, top: int = 100) -> DataFrame:
    """Subscribers with the highest monthly charge: the call list of a warehouse without predictions.

    The rows are picked from the billing table alone and joined to their profile afterwards.
    """
    picked = wh.table("fact_billing").orderBy(F.desc("monthly_charge"), KEY).limit(top)
    columns = [c for names in STAR.values() for c in names]
    others = [name for name in STAR if name != "fact_billing"]
    return picked.join(wh.star(*others), KEY).select(KEY, *columns).orderBy(F.desc("monthly_charge"), KEY)


# Insights ----------------------------------------------------------------------------------------------


def insights_revenue_at_risk(wh: Warehouse) -> DataFrame:
    """Risk-weighted monthly revenue of the at-risk bands, 0 without a calibrated run."""
    total = F.coalesce(product_sum(F.col("monthly_charge"), F.col("risk_score")), F.lit(0.0))
    return _at_risk(_calibrated_with(wh, "fact_billing")).agg(half_even(total, 2).alias("revenue_at_risk"))


def insights_contract(wh: Warehouse) -> DataFrame:
    return (
        wh.star("dim_contract", "fact_attrition_label")
        .groupBy("contract_type")
        .agg(
            F.count("*").alias("total"),
            F.sum(CHURNED).alias("churned"),
            _rate().alias("churn_rate"),
        )
        .orderBy(F.desc("churn_rate"))
    )


def insights_document(wh: Warehouse) -> DataFrame:
    """The two insights as one nested record (one entry per contract type)."""
    rows = insights_contract(wh).agg(
        F.sort_array(F.collect_list(F.struct("churn_rate", "contract_type", "total", "churned")), asc=False)
        .alias("contract_insights")
    )
    return rows.withColumn("revenue_at_risk", insights_revenue_at_risk(wh).scalar())
