"""Cleaning: raw subscribers to 21 typed snake_case columns. Row-wise, no shuffle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.sources.schema import HEADER_OF, INTERNET_ADD_ONS, RAW_COLUMNS

# Rule and rationale texts of the cleaning log.
RULE_BLANK = ("Total Charges blank → 0.0 for Tenure=0", "Subscribers with tenure=0 have not yet been billed.")
RULE_ADD_ON = ("{column}: 'No internet service' → 'No'", "Simplifies encoding.")
RULE_LINES = ("Multiple Lines: 'No phone service' → 'No'", "Redundant.")
RULE_SENIOR = ("Senior Citizen: 0/1 int → 'No'/'Yes'", "Consistent Yes/No.")
RULE_RENAME = ("Rename all columns to snake_case and drop leakage columns", "Consistent naming.")
RULE_LABEL = ("churned_flag: 'Yes'/'No' → 1/0", "Binary target.")

_NUMERIC = ("tinyint", "smallint", "int", "bigint", "float", "double")


def _senior_is_coded(raw: DataFrame) -> bool:
    return dict(raw.dtypes)["senior_citizen"] in _NUMERIC


def clean(raw: DataFrame) -> DataFrame:
    """Apply the cleaning rules and keep only the known columns, so leakage columns fall away.

    A total that cannot be read becomes NULL, and 0.0 only where tenure is 0; an unknown label becomes
    NULL. The constraint report counts both.
    """
    total = F.col("total_charges").try_cast("double")
    rules = {
        "total_charges": F.when(F.col("tenure_months") == 0, F.coalesce(total, F.lit(0.0))).otherwise(total),
        "multiple_lines": F.when(F.col("multiple_lines") == "No phone service", "No").otherwise(
            F.col("multiple_lines")
        ),
        "churn_label": F.when(F.col("churn_label") == "Yes", 1).when(F.col("churn_label") == "No", 0),
    }
    for name in INTERNET_ADD_ONS:
        rules[name] = F.when(F.col(name) == "No internet service", "No").otherwise(F.col(name))
    if _senior_is_coded(raw):
        rules["senior_citizen"] = F.when(F.col("senior_citizen") == 1, "Yes").when(F.col("senior_citizen") == 0, "No")
    return raw.select(*[rules.get(name, F.col(name)).alias(clean_name) for _, name, clean_name, _ in RAW_COLUMNS])


def cleaning_log(raw: DataFrame) -> DataFrame:
    """Rows affected per rule. One aggregate pass over the raw table, then ten rows from its one row."""
    counts, lines = {}, []

    def add(rule, rows, header=""):
        key = f"n{len(lines)}"
        counts[key] = rows
        lines.append((rule[0].format(column=header), key, rule[1]))

    add(RULE_BLANK, F.count_if(F.col("total_charges").try_cast("double").isNull()))
    for name in INTERNET_ADD_ONS:
        add(RULE_ADD_ON, F.count_if(F.col(name) == "No internet service"), HEADER_OF[name])
    add(RULE_LINES, F.count_if(F.col("multiple_lines") == "No phone service"))
    if _senior_is_coded(raw):
        add(RULE_SENIOR, F.count("*"))
    add(RULE_RENAME, F.lit(0).cast("bigint"))
    add(RULE_LABEL, F.count("*"))
    rows = F.array(
        *[
            F.struct(F.lit(rule).alias("rule"), F.col(key).alias("rows_affected"), F.lit(why).alias("rationale"))
            for rule, key, why in lines
        ]
    )
    return raw.agg(*[c.alias(k) for k, c in counts.items()]).select(F.inline(rows))
