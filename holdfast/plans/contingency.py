"""Chi-square association of categorical features with attrition, with effect size and FDR control."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_even, ratio
from holdfast.functions.tails import chi2_p
from holdfast.functions.text import CRAMERS_V_LADDER, fixed, ladder
from holdfast.plans.warehouse import Warehouse

# Tested features, significance level.
FEATURES = [
    "contract_type", "payment_method", "internet_service", "paperless_billing", "is_senior", "has_partner",
    "has_dependents", "gender", "is_autopay",
]
ALPHA = 0.05


def contingency(rows: DataFrame, features: list[str], label: str = "churned_flag") -> DataFrame:
    """Rows and positives per feature value, with the totals of the whole table.

    The rows are first counted per combination of all features, so only the combinations (a few thousand
    for these domains) are fanned out per feature, not the rows.
    """
    combos = rows.groupBy(*features).agg(F.count("*").alias("n"), F.sum(label).alias("k"))
    tagged = F.array(
        *[F.struct(F.lit(f).alias("feature"), F.col(f).cast("string").alias("value")) for f in features]
    )
    return (
        combos.select(F.inline(tagged), "n", "k")
        .groupBy("feature", "value")
        .agg(F.sum("n").alias("n"), F.sum("k").alias("k"))
    )


def chi_square(table: DataFrame) -> DataFrame:
    """Chi-square of each feature from its value counts; continuity correction when one degree is free.

    Both cells of a value deviate from expectation by the same amount, so one term per value is enough.
    Missing values are left out of the table but count in the sample size of the effect size.
    """
    whole = table.groupBy("feature").agg(F.sum("n").alias("n_all"))
    known = table.filter(F.col("value").isNotNull())
    of_feature = W.partitionBy("feature")
    shape = known.withColumns(
        {
            "total": F.sum("n").over(of_feature),
            "positives": F.sum("k").over(of_feature),
            "n_rows": F.count("*").over(of_feature),
        }
    ).withColumn(
        "n_cols", F.when((F.col("positives") > 0) & (F.col("positives") < F.col("total")), 2).otherwise(1)
    )
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    expected = ratio(F.col("n").cast("double") * F.col("positives").cast("double"), F.col("total"))
    other = F.col("n") - expected
    gap = F.abs(F.col("k") - expected)
    gap = gap - F.when(dof == 1, F.least(F.lit(0.5), gap)).otherwise(0.0)
    term = F.when(dof > 0, gap * gap * (F.try_divide(F.lit(1.0), expected) + F.try_divide(F.lit(1.0), other)))
    smaller = F.least(F.max("n_rows"), F.max("n_cols")) - 1
    return (
        shape.groupBy("feature")
        .agg(F.coalesce(F.sum(term), F.lit(0.0)).alias("chi2"), F.max(dof).alias("dof"), smaller.alias("smaller"))
        .join(whole, "feature")
        .withColumn("v", F.coalesce(F.sqrt(ratio(F.col("chi2"), F.col("n_all") * F.col("smaller"))), F.lit(0.0)))
        .withColumn("p", F.when(F.col("dof") == 0, 1.0).otherwise(chi2_p(F.col("chi2"), F.col("dof"))))
        .select("feature", "chi2", "dof", "p", "v")
    )


def benjamini_hochberg(tests: DataFrame, p: str) -> DataFrame:
    """Adjusted p-values. The windows run over one row per test."""
    by_p = W.orderBy(p, "feature")
    m = F.count("*").over(W.partitionBy())
    raw = F.col(p) * m / F.row_number().over(by_p)
    onward = by_p.rowsBetween(W.currentRow, W.unboundedFollowing)
    return tests.withColumn("_raw", raw).withColumn(
        "p_exact", F.least(F.lit(1.0), F.min("_raw").over(onward))
    ).drop("_raw")


def association_tests(wh: Warehouse) -> DataFrame:
    """One row per feature. The adjustment runs on p-values already rounded to six decimals."""
    rows = wh.star("dim_contract", "dim_service_profile", "dim_subscriber", "fact_attrition_label")
    tests = chi_square(contingency(rows, FEATURES)).select(
        "feature",
        F.lit("chi-square").alias("test"),
        half_even(F.col("chi2"), 4).alias("chi2"),
        F.col("dof").cast("bigint").alias("dof"),
        half_even(F.col("p"), 6).alias("p_raw"),
        half_even(F.col("v"), 4).alias("cramers_v"),
        ladder(F.col("v"), CRAMERS_V_LADDER, "negligible").alias("effect_size_label"),
    )
    adjusted = (
        benjamini_hochberg(tests, "p_raw")
        .withColumn("p_adjusted", half_even(F.col("p_exact"), 6))
        .withColumn("bh_significant", F.col("p_exact") <= ALPHA)
        .drop("p_exact")
    )
    # Wording of the finding.
    text = F.concat(
        F.lit("The association between "),
        F.translate("feature", "_", " "),
        F.lit(" and subscriber attrition is "),
        F.when(F.col("bh_significant"), "statistically significant").otherwise("not statistically significant"),
        F.lit(" (adjusted p = "),
        fixed(F.col("p_adjusted"), 3),
        F.lit(") with a "),
        ladder(F.col("cramers_v"), CRAMERS_V_LADDER, "negligible"),
        F.lit(" effect size (Cramér's V = "),
        fixed(F.col("cramers_v"), 3),
        F.lit("). Correlation only — no causal claim is made."),
    )
    return adjusted.withColumn("plain_english", text)
