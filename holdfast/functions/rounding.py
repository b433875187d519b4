"""Rounding and ratio expressions.

``F.round`` works on the decimal text of a double, so it disagrees with other engines on ties. Two
explicit rules are used instead, both plain double arithmetic that any engine can repeat.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

MONEY = "decimal(18,2)"


def half_away(x: Column, digits: int) -> Column:
    """Round half away from zero (the rule of ROUND in SQL reports). Stays in doubles, since ``floor`` gives a bigint that
    saturates; doubles from 2^52 / 10^digits on have no digits to round and stay as they are."""
    scale = float(10**digits)
    shifted = F.abs(x) * F.lit(scale) + F.lit(0.5)
    nearest = F.rint(shifted)
    floor = nearest - F.when(nearest > shifted, F.lit(1.0)).otherwise(F.lit(0.0))
    return F.when(F.abs(x) >= F.lit(2.0**52 / scale), x).otherwise(F.signum(x) * floor / F.lit(scale))


def half_even(x: Column, digits: int) -> Column:
    """Round half to even (the rule of row features and planner figures)."""
    scale = float(10**digits)
    return F.rint(x * F.lit(scale)) / F.lit(scale)


def ratio(a: Column, b: Column) -> Column:
    """a / b as double, NULL where b is 0."""
    return F.try_divide(a.cast("double"), b.cast("double"))


def money_sum(x: Column) -> Column:
    """Sum of two-decimal amounts that does not depend on row order."""
    return F.sum(x.cast(MONEY)).cast("double")


def money_avg(x: Column) -> Column:
    """Average of two-decimal amounts that does not depend on row order."""
    return ratio(F.sum(x.cast(MONEY)), F.count(x))


def product_sum(a: Column, b: Column) -> Column:
    """Sum of a*b kept at 8 decimals, so the total does not depend on row order."""
    return F.sum((a * b).cast("decimal(28,8)")).cast("double")
