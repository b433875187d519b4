"""Two-group comparison of numeric features: moments, Welch t, Mann-Whitney, effect sizes, bootstrap."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_even, ratio
from holdfast.functions.tails import normal_p, student_p
from holdfast.functions.text import COHENS_D_LADDER, fixed, ladder
from holdfast.operators.prefix import running_totals
from holdfast.plans.warehouse import Warehouse

# Compared features, resamples, seed, interval bounds, significance level.
FEATURES = ["tenure_months", "monthly_charge"]
RESAMPLES, SEED = 2000, 42
INTERVAL = (0.025, 0.975)
LARGE, DRAW_BITS = 16, 15  # rows of a value from which they are drawn together; bits of a uniform draw
ALPHA = 0.05
WIDE = "decimal(19,0)"


def feature_values(rows: DataFrame, features: list[str], label: str = "churned_flag") -> DataFrame:
    """(feature, value, label) rows without missing values."""
    pairs = F.array(*[F.struct(F.lit(f).alias("feature"), F.col(f).cast("double").alias("value")) for f in features])
    return rows.select(F.inline(pairs), F.col(label).alias("label")).filter(
        F.col("value").isNotNull() & F.col("label").isNotNull()
    )


def histogram(values: DataFrame) -> DataFrame:
    """Churned and retained rows per distinct value: all that ranks and resampling need."""
    return values.groupBy("feature", "value").agg(
        F.sum("label").alias("pos"), F.sum(1 - F.col("label")).alias("neg")
    )


def moments(values: DataFrame) -> DataFrame:
    """Size, mean, sample deviation and population skew of both groups in one aggregate pass."""
    value = F.col("value")
    aggregates = []
    for flag, group in ((1, "churned"), (0, "retained")):
        x = F.when(F.col("label") == flag, value)
        aggregates += [
            F.count(x).alias(f"n_{group}"),
            F.avg(x).alias(f"mean_{group}"),
            F.stddev_samp(x).alias(f"std_{group}"),
            F.skewness(x).alias(f"skew_{group}"),
        ]
    return values.groupBy("feature").agg(*aggregates)


def rank_sums(hist: DataFrame) -> DataFrame:
    """Mann-Whitney U of the churned group, and the tie term of its variance."""
    ranked = running_totals(hist, ["feature"], "value", ["pos", "neg"])
    tied = (F.col("pos") + F.col("neg")).cast("double")
    pairs = F.sum(F.col("pos").cast(WIDE) * (2 * F.col("neg_below") + F.col("neg")).cast(WIDE))
    return ranked.groupBy("feature").agg(
        (pairs.cast("double") / 2.0).alias("u"), F.sum(tied * tied * tied - tied).alias("ties")
    )


def two_group_figures(m: DataFrame) -> DataFrame:
    """Test statistics and effect sizes from the moments and rank sums of each feature."""
    n1, n2 = F.col("n_churned").cast("double"), F.col("n_retained").cast("double")
    mean1, mean2 = F.col("mean_churned"), F.col("mean_retained")
    s1, s2 = F.col("std_churned"), F.col("std_retained")
    a, b = s1 * s1 / n1, s2 * s2 / n2
    pooled = F.sqrt(((n1 - 1) * s1 * s1 + (n2 - 1) * s2 * s2) / (n1 + n2 - 2))
    u_top = F.greatest(F.col("u"), n1 * n2 - F.col("u"))
    n = n1 + n2
    sigma = F.sqrt(n1 * n2 / 12.0 * ((n + 1) - F.col("ties") / (n * (n - 1))))
    return m.withColumns(
        {
            "t": F.try_divide(mean1 - mean2, F.sqrt(a + b)),
            "dof": F.try_divide((a + b) * (a + b), a * a / (n1 - 1) + b * b / (n2 - 1)),
            "d": F.when(pooled == 0, 0.0).otherwise(F.try_divide(mean1 - mean2, pooled)),
            "z": F.try_divide(u_top - n1 * n2 / 2.0 - 0.5, sigma),
            "r": 1.0 - F.try_divide(2.0 * F.col("u"), n1 * n2),
        }
    )


def numeric_tests(wh: Warehouse, features: list[str] = FEATURES) -> DataFrame:
    """All figures but the bootstrap interval, one row per feature."""
    values = feature_values(wh.star("dim_subscriber", "fact_billing", "fact_attrition_label"), features)
    figures = two_group_figures(moments(values).join(rank_sums(histogram(values)), "feature"))
    report = figures.select(
        "feature",
        "n_churned",
        "n_retained",
        *[half_even(F.col(f"{k}_{g}"), 3).alias(f"{k}_{g}") for k in ("mean", "std", "skew") for g in ("churned", "retained")],
        half_even(F.col("t"), 4).alias("t_stat"),
        half_even(student_p(F.col("t"), F.col("dof")), 6).alias("p_ttest"),
        half_even(F.col("u"), 1).alias("u_stat"),
        half_even(normal_p(F.col("z")), 6).alias("p_mwu"),
        half_even(F.col("d"), 4).alias("cohens_d"),
        ladder(F.abs("d"), COHENS_D_LADDER, "negligible").alias("effect_label"),
        half_even(F.col("r"), 4).alias("rank_biserial_r"),
    )
    return report.withColumn("plain_english", _finding())


def _finding() -> Column:
    # Wording of the finding.
    return F.concat(
        F.lit("Churned subscribers have "),
        F.when(F.col("mean_churned") > F.col("mean_retained"), "higher").otherwise("lower"),
        F.lit(" "),
        F.translate("feature", "_", " "),
        F.lit(" on average (churned: "),
        fixed(F.col("mean_churned"), 1),
        F.lit(", retained: "),
        fixed(F.col("mean_retained"), 1),
        F.lit("). The difference is "),
        F.when(F.col("p_ttest") < ALPHA, "statistically significant").otherwise("not statistically significant"),
        F.lit(" (t-test p = "),
        fixed(F.col("p_ttest"), 4),
        F.lit("), with a "),
        ladder(F.abs("cohens_d"), COHENS_D_LADDER, "negligible"),
        F.lit(" effect (Cohen's d = "),
        fixed(F.col("cohens_d"), 3),
        F.lit("). Correlation only — no causal claim is made."),
    )


def poisson_thresholds(rate: int, bits: int = DRAW_BITS) -> list[int]:
    """Whole numbers t(0) < t(1) < ...: a uniform draw u of so many bits means Poisson(rate) = number of thresholds <= u."""
    total, term, found = 0.0, math.exp(-rate), []
    for k in range(20 + 10 * rate):
        total += term
        at = round(total * (1 << bits))
        if at >= 1 << bits:
            break
        found.append(at)
        term *= rate / (k + 1)
    return found


def _weighted(cells: DataFrame) -> DataFrame:
    """``cells`` (n, key) with ``w``, a Poisson(n) draw, the sum of as many independent Poisson(1) weights, as a function of the key.

    The count is split into powers of two below ``LARGE``, each drawn from its bits of the key's MD5 by inverting the distribution's
    thresholds, and a multiple of ``LARGE``, drawn as a rounded normal variable: the sum of 12 bytes of a second MD5, centred.
    """

    def number(salt: str, at: int, digits: int) -> Column:
        return F.conv(F.substring(F.md5(F.concat("key", F.lit(salt))), at, digits), 16, 10).cast("bigint")

    def drawn(bit: int) -> Column:
        at, *others = poisson_thresholds(1 << bit)
        steps = F.when(F.col(f"_u{bit}") < at, 0)
        for k, t in enumerate(others, start=1):
            steps = steps.when(F.col(f"_u{bit}") < t, k)
        return F.when(F.shiftright("n", bit).bitwiseAND(1) == 1, steps.otherwise(len(others) + 1)).otherwise(0)

    powers = range(LARGE.bit_length() - 1)
    rest = F.col("n") - F.col("n") % LARGE
    hashed = cells.withColumns({"_a": number("|a", 1, 15), "_b": F.when(rest > 0, number("|b", 1, 12)), "_c": F.when(rest > 0, number("|b", 13, 12))})
    parted = hashed.withColumns({f"_u{bit}": F.shiftright("_a", DRAW_BITS * bit).bitwiseAND((1 << DRAW_BITS) - 1) for bit in powers})
    bytes_ = sum((F.shiftright(name, 8 * k).bitwiseAND(255) for name in ("_b", "_c") for k in range(6)), F.lit(0))
    z = (bytes_ - 12 * 255 / 2) / F.lit(math.sqrt(2**16 - 1))  # a byte has variance (2^16 - 1) / 12
    large = F.when(rest > 0, F.greatest(F.lit(0.0), F.floor(rest + F.sqrt(rest.cast("double")) * z + 0.5).cast("double"))).otherwise(0.0)
    return parted.withColumn("w", sum((drawn(bit) for bit in powers), F.lit(0)).cast("double") + large)


def resample_totals(hist: DataFrame, resamples: int = RESAMPLES) -> DataFrame:
    """(feature, resample, w1, x1, w0, x0): weights and weighted values of both groups in each Poisson resample of a histogram.

    Draws are column expressions of feature, value, group and resample, so neither partitioning nor retries change them, and sums of
    parts of the histogram add up.
    """
    sides = F.array(*[F.struct(F.lit(flag).alias("flag"), F.col(c).cast("bigint").alias("n")) for flag, c in ((1, "pos"), (0, "neg"))])
    cells = hist.select("feature", "value", F.inline(sides)).filter("n > 0")
    named = cells.withColumn("name", F.concat_ws("|", F.lit(str(SEED)), "feature", F.format_string("%.4f", "value"), F.col("flag").cast("string")))
    # a fixed number of tasks: by its size the histogram would be one, and the resamples are many times as much
    dealt = named.repartition(int(hist.sparkSession.conf.get("spark.sql.shuffle.partitions")), "name")
    spread = dealt.withColumn("resample", F.explode(F.sequence(F.lit(0), F.lit(resamples - 1))))
    drawn = _weighted(spread.withColumn("key", F.concat("name", F.lit("|"), F.col("resample").cast("string"))))

    def total(flag: int, what: Column) -> Column:
        return F.sum(F.when(F.col("flag") == flag, what).otherwise(0.0))

    w, x = F.col("w"), F.col("w") * F.col("value")
    return drawn.groupBy("feature", "resample").agg(total(1, w).alias("w1"), total(1, x).alias("x1"), total(0, w).alias("w0"), total(0, x).alias("x0"))


def bootstrap_intervals(wh: Warehouse, features: list[str] = FEATURES) -> DataFrame:
    """95% interval of the mean difference by Poisson bootstrap over the value histogram.

    Work and traffic follow the number of distinct values, not of rows: each task sends one partial sum per
    feature and resample.
    """
    values = feature_values(wh.star("dim_subscriber", "fact_billing", "fact_attrition_label"), features)
    difference = ratio(F.col("x1"), F.col("w1")) - ratio(F.col("x0"), F.col("w0"))
    bounds = F.percentile(difference, F.array(*[F.lit(q) for q in INTERVAL]))
    return resample_totals(histogram(values)).groupBy("feature").agg(bounds.alias("q")).select(
        "feature",
        half_even(F.col("q")[0], 3).alias("bootstrap_ci_lo"),
        half_even(F.col("q")[1], 3).alias("bootstrap_ci_hi"),
    )


def numeric_report(wh: Warehouse) -> DataFrame:
    """The full report: tests and bootstrap interval."""
    return numeric_tests(wh).join(bootstrap_intervals(wh), "feature")
