"""The logistic fit agrees with a plain Newton iteration on the same rows."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.plans import odds
from holdfast.plans.warehouse import open_warehouse


def test_odds_ratios_equal_newton(spark):
    wh = open_warehouse(spark, "/root/testdata/sf0.01")
    table = odds.design(wh).toPandas().to_numpy()
    x, y = np.column_stack([np.ones(len(table)), table[:, :-1]]), table[:, -1]
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-x @ beta))
        information = x.T @ (x * (p * (1 - p))[:, None])
        step = np.linalg.solve(information, x.T @ (y - p))
        beta += step
        if np.abs(step).max() < 1e-12:
            break
    errors = np.sqrt(np.diag(np.linalg.inv(information)))
    got = {r.feature: r for r in odds.odds_ratios(wh).collect()}
    assert list(got) == list(odds.DESIGN)
    for i, name in enumerate(odds.DESIGN, start=1):
        assert got[name].log_odds == pytest.approx(beta[i], abs=6e-5)
        assert got[name].odds_ratio == pytest.approx(np.exp(beta[i]), abs=6e-5)
        assert got[name].or_ci_lo == pytest.approx(np.exp(beta[i] - 1.959964 * errors[i]), abs=1e-4)
        assert got[name].or_ci_hi == pytest.approx(np.exp(beta[i] + 1.959964 * errors[i]), abs=1e-4)
        assert got[name].significant == (got[name].p_value < 0.05)


def test_equal_rows_are_counted_once_and_odd_designs_are_errors(spark):
    names = list(odds.DESIGN)
    draw = np.random.default_rng(3)
    x = draw.integers(0, 2, (400, len(names))).astype(float)
    y = (draw.random(400) < 1 / (1 + np.exp(-(x[:, 0] - x[:, 1])))).astype(float)
    rows = [(*map(float, r), float(v)) for r, v in zip(x, y)]
    schema = ", ".join(f"{n} double" for n in names) + ", label double"

    def cells(rows):
        return spark.createDataFrame(rows, schema).groupBy(*names).agg(F.count("*").alias("n"), F.sum("label").alias("y"))

    beta, errors = odds.newton_fit(cells(rows))
    many, few = odds.newton_fit(cells(rows * 4))
    assert np.allclose(beta, many, atol=1e-9) and np.allclose(errors, 2 * few, atol=1e-9)
    _, score, _ = odds.newton_sums(cells(rows), beta)
    assert np.abs(score).max() < 1e-6
    same = [(*r[:1], r[0], *r[2:]) for r in rows]
    apart = [(*r[:-1], r[0]) for r in rows]
    for bad in (same, apart, []):
        with pytest.raises(ValueError):
            odds.newton_fit(cells(bad))
