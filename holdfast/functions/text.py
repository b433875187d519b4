"""Labels and number texts for report rows."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Effect-size ladders and risk-band cut-offs.
CRAMERS_V_LADDER = [(0.35, "large"), (0.20, "moderate"), (0.10, "small")]
COHENS_D_LADDER = [(0.8, "large"), (0.5, "moderate"), (0.2, "small")]
RISK_HIGH, RISK_MEDIUM = 0.55, 0.35


def ladder(x: Column, steps: list[tuple[float, str]], otherwise: str) -> Column:
    """Label of the first step whose lower bound x reaches."""
    label = F.lit(otherwise)
    for bound, name in reversed(steps):
        label = F.when(x >= F.lit(bound), F.lit(name)).otherwise(label)
    return label


def risk_band(score: Column, high: float = RISK_HIGH, medium: float = RISK_MEDIUM) -> Column:
    return ladder(score, [(high, "High"), (medium, "Medium")], "Low")


@F.pandas_udf(StringType())
def _fixed(x: pd.Series, digits: pd.Series) -> pd.Series:
    return pd.Series([None if pd.isna(v) else f"{v:.{int(d)}f}" for v, d in zip(x, digits)], dtype="object")


def fixed(x: Column, digits: int) -> Column:
    """Number text rounded on the exact binary value, as C and Python print it.

    ``format_string`` rounds the shortest decimal text instead and differs on values ending in 5. Use
    only on report rows (a few dozen), not on data rows.
    """
    return _fixed(x, F.lit(digits))
