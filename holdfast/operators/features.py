"""Nine label-free, row-wise features. No shuffle; all inside code generation."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_even
from holdfast.sources.schema import (
    AUTOPAY, COMMITMENT, COUNTED_SERVICES, LAST_BAND, OUT_OF_RANGE_BAND, PROTECTION, TENURE_BANDS,
)


def _yes_count(columns: list[str]) -> Column:
    return reduce(lambda a, b: a + b, [F.coalesce((F.col(c) == "Yes").cast("int"), F.lit(0)) for c in columns])


def tenure_band(tenure: Column) -> Column:
    """Right-closed bands; a negative or missing tenure has no band."""
    band = F.when(tenure.isNull() | (tenure < 0), OUT_OF_RANGE_BAND)
    for upper, label in TENURE_BANDS:
        band = band.when(tenure <= upper, label)
    return band.otherwise(LAST_BAND)


def _flag(condition: Column) -> Column:
    return F.coalesce(condition.cast("int"), F.lit(0))


def add_features(cleaned: DataFrame) -> DataFrame:
    tenure = F.col("tenure_months")
    commitment = F.lit(None).cast("int")
    for contract, months in COMMITMENT.items():
        commitment = F.when(F.col("contract_type") == contract, months).otherwise(commitment)
    with_spend = cleaned.withColumns(
        {
            "tenure_band": tenure_band(tenure),
            "services_count": _yes_count(COUNTED_SERVICES).cast("bigint"),
            "has_protection_bundle": (_yes_count(PROTECTION) >= 2).cast("int"),
            "avg_monthly_spend_to_date": half_even(
                F.col("lifetime_billed") / F.when(tenure < 1, 1).otherwise(tenure), 2
            ),
        }
    )
    return with_spend.withColumns(
        {
            "price_vs_history_gap": half_even(F.col("monthly_charge") - F.col("avg_monthly_spend_to_date"), 2),
            "is_autopay": _flag(F.col("payment_method").isin(AUTOPAY)),
            "is_new_subscriber": _flag(tenure <= 6),
            "fibre_without_support": _flag(
                (F.col("internet_service") == "Fiber optic")
                & (F.col("online_security") == "No")
                & (F.col("tech_support") == "No")
            ),
            "contract_commitment_months": commitment,
        }
    )
