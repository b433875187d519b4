"""Logistic odds ratios and variance inflation of the 15-column numeric design."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType

from holdfast.functions.rounding import half_away, half_even
from holdfast.functions.tails import normal_p
from holdfast.functions.text import fixed
from holdfast.plans.warehouse import Warehouse
from holdfast.sources.schema import STAR

# Design columns as SQL expressions, normal quantile of a 95% interval, significance level.
DESIGN = {
    "tenure_months": "tenure_months",
    "monthly_charge": "monthly_charge",
    "services_count": "services_count",
    "is_senior": "is_senior = 'Yes'",
    "has_partner": "has_partner = 'Yes'",
    "has_dependents": "has_dependents = 'Yes'",
    "is_autopay": "is_autopay",
    "is_new_subscriber": "is_new_subscriber",
    "fibre_without_support": "fibre_without_support",
    "has_protection_bundle": "has_protection_bundle",
    "contract_one_year": "contract_type = 'One year'",
    "contract_two_year": "contract_type = 'Two year'",
    "internet_fibre": "internet_service = 'Fiber optic'",
    "internet_dsl": "internet_service = 'DSL'",
    "paperless_billing": "paperless_billing = 'Yes'",
}
Z95 = 1.959963984540054
ALPHA = 0.05


def design(wh: Warehouse) -> DataFrame:
    """Complete rows of the design and the label."""
    rows = wh.star(*STAR)
    columns = [F.expr(rule).cast("double").alias(name) for name, rule in DESIGN.items()]
    return rows.select(*columns, F.col("churned_flag").cast("double").alias("label")).dropna()


def design_cells(wh: Warehouse) -> DataFrame:
    """Rows of the design that are equal, with their number and positives: all that a fit needs. Cells follow the domains of the columns,
    not the rows."""
    return design(wh).groupBy(*DESIGN).agg(F.count("*").alias("n"), F.sum("label").alias("y"))


def _partial_sums(beta: np.ndarray):
    """Sums of one task's cells, numbered: upper triangle of the information matrix, score vector, log likelihood."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        size = len(beta)
        information, score, likelihood = np.zeros((size, size)), np.zeros(size), 0.0
        for batch in batches:
            n, y, *columns = (c.to_numpy(zero_copy_only=False).astype(float) for c in batch.columns)
            x = np.column_stack([np.ones(len(n)), *columns])
            eta = x @ beta
            p = 1 / (1 + np.exp(-eta))
            information += x.T @ (x * (n * p * (1 - p))[:, None])
            score += x.T @ (y - n * p)
            likelihood += float(y @ eta - n @ np.logaddexp(0, eta))
        sums = np.concatenate([information[np.triu_indices(size)], score, [likelihood]])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(sums)), pa.int32()), pa.array(sums)], names=["k", "s"])

    return run


def newton_sums(cells: DataFrame, beta: np.ndarray) -> tuple[np.ndarray, np.ndarray, float]:
    """Information matrix, score vector and log likelihood at ``beta`` (the intercept first): one pass over the cells, whose tasks
    send one row for each of the sums."""
    size = len(beta)
    parts = cells.select("n", "y", *DESIGN).mapInArrow(_partial_sums(beta), "k int, s double")
    row = np.array([r.s for r in parts.groupBy("k").agg(F.sum("s").alias("s")).orderBy("k").collect()])
    information = np.zeros((size, size))
    information[np.triu_indices(size)] = row[: -size - 1]
    information += np.triu(information, 1).T
    return information, row[-size - 1 : -1], float(row[-1])


def newton_fit(cells: DataFrame, steps: int = 50, tolerance: float = 1e-6) -> tuple[np.ndarray, np.ndarray]:
    """Coefficients and standard errors of the unpenalised logistic fit, the intercept first.

    Newton's method from zero: a step is halved while it lowers the likelihood. What is left to go after a step of size d is of the
    order of d squared, so the last one need not be below the root of the wanted accuracy. A design whose columns depend on each other, or
    whose fit does not settle (classes that a plane separates), is an error.
    """
    beta = np.zeros(len(DESIGN) + 1)
    information, score, likelihood = newton_sums(cells, beta)
    if not information.any():
        raise ValueError("the design has no complete rows")
    for _ in range(steps):
        if np.linalg.matrix_rank(information, hermitian=True) < len(beta):
            raise ValueError("columns of the design depend on each other, or the classes are separated")
        step = np.linalg.solve(information, score)
        while True:
            found = newton_sums(cells, beta + step)
            if found[2] >= likelihood - 1e-9 * abs(likelihood) or np.abs(step).max() < tolerance:
                break
            step /= 2
        beta = beta + step
        information, score, likelihood = found
        if np.abs(step).max() < tolerance:
            return beta, np.sqrt(np.diag(np.linalg.inv(information)))
    raise ValueError(f"the fit did not settle in {steps} steps")


def odds_ratios(wh: Warehouse) -> DataFrame:
    """Coefficients of the unpenalised logistic fit, one row per design column.

    Equal rows are counted once; each Newton step then sums a 16 x 16 system over the counted cells, and only that reaches the driver.
    """
    cells = design_cells(wh).persist()
    try:
        beta, errors = newton_fit(cells)
    finally:
        cells.unpersist()
    rows = [(i, name, float(beta[i]), float(errors[i])) for i, name in enumerate(DESIGN, start=1)]
    fitted = wh.spark.createDataFrame(rows, "position int, feature string, b double, se double").withColumn("p", normal_p(F.abs(F.col("b") / F.col("se"))))
    b, reach = F.col("b"), F.lit(Z95) * F.col("se")
    report = fitted.orderBy("position").select(
        "feature",
        half_even(b, 4).alias("log_odds"),
        half_even(F.exp(b), 4).alias("odds_ratio"),
        half_even(F.exp(b - reach), 4).alias("or_ci_lo"),
        half_even(F.exp(b + reach), 4).alias("or_ci_hi"),
        half_even(F.col("p"), 6).alias("p_value"),
    )
    # Wording of the finding.
    text = F.concat(
        F.lit("A one-unit increase in "),
        F.translate("feature", "_", " "),
        F.lit(" is associated with an odds ratio of "),
        fixed(F.col("odds_ratio"), 2),
        F.lit(" (95% CI: "),
        fixed(F.col("or_ci_lo"), 2),
        F.lit("–"),
        fixed(F.col("or_ci_hi"), 2),
        F.lit("), "),
        F.when(F.col("significant"), "significant").otherwise("not significant"),
        F.lit(" at p = "),
        fixed(F.col("p_value"), 3),
        F.lit(". Correlation only — no causal claim is made."),
    )
    return report.withColumn("significant", F.col("p_value") < ALPHA).withColumn("plain_english", text)


def gram_matrix(wh: Warehouse) -> DataFrame:
    """Sums of products of all column pairs (upper triangle), one row per pair, from one aggregate pass."""
    names = list(DESIGN)
    pairs = [(i, j) for i in range(len(names)) for j in range(i, len(names))]
    sums = design(wh).agg(*[F.expr(f"sum({names[i]} * {names[j]}) AS s{k}") for k, (i, j) in enumerate(pairs)])
    cells = ", ".join(f"named_struct('i', {i + 1}, 'j', {j + 1}, 's', s{k})" for k, (i, j) in enumerate(pairs))
    return sums.selectExpr(f"inline(array({cells}))").select("i", "j", half_away(F.col("s"), 4).alias("s"))


@F.pandas_udf(ArrayType(DoubleType()))
def _inflation(triangles: pd.Series) -> pd.Series:
    """diag(G) * diag(inverse(G)) of the one 15 x 15 matrix."""

    def one(values: np.ndarray) -> list[float]:
        size = len(DESIGN)
        g = np.zeros((size, size))
        g[np.triu_indices(size)] = values
        g = g + np.triu(g, 1).T
        return list(np.diag(g) * np.diag(np.linalg.inv(g)))

    return pd.Series([one(np.asarray(v, dtype=float)) for v in triangles])


def vif(wh: Warehouse) -> DataFrame:
    """Variance inflation per design column, without intercept (uncentred R squared)."""
    cells = gram_matrix(wh).agg(F.array_sort(F.collect_list(F.struct("i", "j", "s"))).alias("cells"))
    factors = cells.select(F.posexplode(_inflation(F.col("cells.s"))).alias("position", "factor"))
    names = F.array(*[F.lit(n) for n in DESIGN])
    return factors.select(F.get(names, F.col("position")).alias("feature"), half_even(F.col("factor"), 2).alias("vif"))
