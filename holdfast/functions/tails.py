"""Upper-tail probabilities, applied to the one result row of each test (never to data rows)."""

from __future__ import annotations

import math

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def chi2_tail(x: float, dof: int) -> float:
    """P(chi-square with ``dof`` degrees of freedom >= x), closed form for whole dof."""
    if x <= 0:
        return 1.0
    half = x / 2.0
    if dof % 2 == 0:
        term = total = math.exp(-half)
        for i in range(1, dof // 2):
            term *= half / i
            total += term
        return min(1.0, total)
    total = math.erfc(math.sqrt(half))
    term = math.exp(-half) * math.sqrt(half) / math.gamma(1.5)
    for i in range(1, (dof - 1) // 2 + 1):
        total += term
        term *= half / (i + 0.5)
    return min(1.0, total)


def normal_two_sided(z: float) -> float:
    """2 * P(Z >= z), at most 1 (a continuity correction can push z just below 0)."""
    return min(1.0, math.erfc(z / math.sqrt(2.0)))


def student_two_sided(t: float, dof: float) -> float:
    """P(|T| >= |t|) as the regularised incomplete beta I_{dof/(dof+t^2)}(dof/2, 1/2)."""
    x = dof / (dof + t * t)
    if x >= 1.0:
        return 1.0
    a, b = dof / 2.0, 0.5
    front = math.exp(
        math.lgamma(a + b) - math.lgamma(a) - math.lgamma(b) + a * math.log(x) + b * math.log1p(-x)
    )
    if x < (a + 1.0) / (a + b + 2.0):
        return front * _beta_fraction(a, b, x) / a
    return 1.0 - front * _beta_fraction(b, a, 1.0 - x) / b


def _beta_fraction(a: float, b: float, x: float) -> float:
    """Continued fraction of the incomplete beta, evaluated by the modified Lentz method."""
    tiny = 1e-300
    c, d = 1.0, 1.0 / max(1.0 - (a + b) * x / (a + 1.0), tiny)
    value = d
    for m in range(1, 500):
        for num in (
            m * (b - m) * x / ((a + 2 * m - 1) * (a + 2 * m)),
            -(a + m) * (a + b + m) * x / ((a + 2 * m) * (a + 2 * m + 1)),
        ):
            d = 1.0 + num * d
            d = 1.0 / (d if abs(d) > tiny else tiny)
            c = 1.0 + num / c
            c = c if abs(c) > tiny else tiny
            step = c * d
            value *= step
        if abs(step - 1.0) < 1e-15:
            break
    return value


def _per_row(fn, *series: pd.Series) -> pd.Series:
    return pd.Series(
        [None if any(pd.isna(v) for v in row) else fn(*row) for row in zip(*series)], dtype="float64"
    )


@F.pandas_udf(DoubleType())
def _chi2(x: pd.Series, dof: pd.Series) -> pd.Series:
    return _per_row(lambda v, k: chi2_tail(v, int(k)), x, dof)


@F.pandas_udf(DoubleType())
def _normal(z: pd.Series) -> pd.Series:
    return _per_row(normal_two_sided, z)


@F.pandas_udf(DoubleType())
def _student(t: pd.Series, dof: pd.Series) -> pd.Series:
    return _per_row(student_two_sided, t, dof)


def chi2_p(x: Column, dof: Column) -> Column:
    return _chi2(x, dof)


def normal_p(z: Column) -> Column:
    return _normal(z)


def student_p(t: Column, dof: Column) -> Column:
    return _student(t, dof)
