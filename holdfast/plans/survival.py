"""Kaplan-Meier retention curves per contract and the log-rank test.

Everything after the first aggregate works on one row per contract and tenure month.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from holdfast.functions.rounding import half_away, half_even, ratio
from holdfast.functions.tails import chi2_p
from holdfast.functions.text import fixed
from holdfast.plans.warehouse import Warehouse

GROUP = "contract_type"
DIGITS = 10
ALPHA = 0.05  # Fixed value: significance level.


def life_table(rows: DataFrame, group: str = GROUP) -> DataFrame:
    """Per group and duration: leavers, rows ending there, and rows still at risk."""
    later = W.partitionBy(group).orderBy("timeline").rowsBetween(W.currentRow, W.unboundedFollowing)
    return (
        rows.groupBy(group, F.col("tenure_months").cast("double").alias("timeline"))
        .agg(F.sum("churned_flag").alias("events"), F.count("*").alias("ended"))
        .withColumn("at_risk", F.sum("ended").over(later))
    )


def curves(table: DataFrame, group: str = GROUP) -> DataFrame:
    """Survival probability at 0 and at every observed duration.

    The product of (1 - d/n) is a sum of logarithms. A step with d = n has no logarithm, so from that step
    on the probability is set to 0.
    """
    origin = table.select(group).distinct().select(
        group, F.lit(0.0).alias("timeline"), F.lit(0).cast("bigint").alias("events"), F.lit(1).cast("bigint").alias("at_risk")
    )
    steps = (
        table.select(group, "timeline", "events", "at_risk")
        .unionByName(origin.join(table.filter("timeline = 0"), [group, "timeline"], "left_anti"))
    )
    so_far = W.partitionBy(group).orderBy("timeline").rowsBetween(W.unboundedPreceding, W.currentRow)
    stays = 1.0 - ratio(F.col("events"), F.col("at_risk"))
    extinct = F.max((F.col("events") == F.col("at_risk")).cast("int")).over(so_far) == 1
    log_sum = F.sum(F.when(stays > 0, F.ln(stays)).otherwise(0.0)).over(so_far)
    return steps.select(
        "timeline",
        F.when(extinct, 0.0).otherwise(half_away(F.exp(log_sum), DIGITS)).alias("survival_prob"),
        group,
    )


def _rows(wh: Warehouse) -> DataFrame:
    return wh.star("dim_subscriber", "dim_contract", "fact_attrition_label")


def km_curves(wh: Warehouse) -> DataFrame:
    return curves(life_table(_rows(wh)))


@F.pandas_udf(DoubleType())
def _quadratic_form(z: pd.Series, v: pd.Series) -> pd.Series:
    """z' V^-1 z of the one row of sums, leaving out the last group."""

    def one(z_values, v_values) -> float:
        k = len(z_values) - 1
        if k < 1:
            return 0.0
        matrix = np.asarray(v_values, dtype=float).reshape(k + 1, k + 1)[:k, :k]
        head = np.asarray(z_values, dtype=float)[:k]
        return float(head @ np.linalg.pinv(matrix) @ head)

    return pd.Series([one(a, b) for a, b in zip(z, v)], dtype="float64")


def log_rank(table: DataFrame, group: str = GROUP) -> DataFrame:
    """Log-rank statistic over all groups, its degrees of freedom and p-value. One row.

    The grid holds every (duration, group) pair, a few hundred rows; groups come from the table itself.
    """
    groups = table.agg(F.array_sort(F.collect_set(group)).alias("groups"))
    grid = (
        table.select("timeline").distinct()
        .withColumn("groups", groups.scalar())
        .select("timeline", F.posexplode("groups").alias("g", group))
        .join(table.select("timeline", group, "events", "ended"), ["timeline", group], "left")
        .fillna(0, ["events", "ended"])
    )
    later = W.partitionBy("g").orderBy("timeline").rowsBetween(W.currentRow, W.unboundedFollowing)
    at_time = W.partitionBy("timeline")
    in_order = at_time.orderBy("g").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    risk = (
        grid.withColumn("n_g", F.sum("ended").over(later))
        .withColumns({"d": F.sum("events").over(at_time), "n": F.sum("n_g").over(at_time)})
        .withColumn("all_n", F.collect_list("n_g").over(in_order))
    )
    share = ratio(F.col("n_g"), F.col("n"))
    excess = risk.groupBy("g").agg(F.sum(F.col("events") - F.col("d") * share).alias("z"))
    spread = F.col("d") * F.coalesce(ratio(F.col("n") - F.col("d"), F.col("n") - 1), F.lit(1.0))
    same = (F.col("g") == F.col("h")).cast("double")
    variance = (
        risk.select("*", F.posexplode("all_n").alias("h", "n_h"))
        .groupBy("g", "h")
        .agg(F.sum(spread * share * (same - ratio(F.col("n_h"), F.col("n")))).alias("v"))
    )
    z = excess.agg(F.array_sort(F.collect_list(F.struct("g", "z"))).alias("z"))
    v = variance.agg(F.array_sort(F.collect_list(F.struct("g", "h", "v"))).alias("v"))
    return (
        z.withColumn("v", v.scalar())
        .select(_quadratic_form(F.col("z.z"), F.col("v.v")).alias("statistic"), (F.size("z") - 1).alias("dof"))
        .withColumn("p", F.when(F.col("dof") < 1, 1.0).otherwise(chi2_p(F.col("statistic"), F.col("dof"))))
    )


def km_summary(wh: Warehouse) -> DataFrame:
    """Size, events and median retention per contract, with the global log-rank test."""
    table = life_table(_rows(wh))
    median = curves(table).groupBy(GROUP).agg(
        F.min(F.when(F.col("survival_prob") <= 0.5, F.col("timeline"))).alias("median_survival_months")
    )
    sizes = table.groupBy(GROUP).agg(F.sum("ended").alias("n_subscribers"), F.sum("events").alias("n_events"))
    p = log_rank(table).select("p").scalar()
    report = sizes.join(median, GROUP).withColumn("p", p).withColumn("logrank_significant", F.col("p") < ALPHA)
    # Wording of the finding.
    text = F.concat(
        F.col(GROUP),
        F.lit(" subscribers: "),
        fixed(ratio(F.col("n_events"), F.col("n_subscribers")) * 100, 1),
        F.lit("% attrition rate. Median retention: "),
        F.coalesce(
            F.concat(F.col("median_survival_months").cast("bigint").cast("string"), F.lit(" months")),
            F.lit("not reached (>50% still active)"),
        ),
        F.lit(". Global log-rank test: p = "),
        fixed(F.col("p"), 4),
        F.when(F.col("logrank_significant"), " (significant").otherwise(" (not significant"),
        F.lit(" difference across groups)."),
    )
    return report.select(
        GROUP,
        "n_subscribers",
        "n_events",
        "median_survival_months",
        text.alias("plain_english"),
        half_even(F.col("p"), 6).alias("logrank_p_global"),
        "logrank_significant",
    )
