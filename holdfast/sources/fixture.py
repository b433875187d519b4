"""Input tables derived from the ``customer`` and ``orders`` test data.

``RAW_SQL`` runs unchanged on Spark and on the oracle engine; only the two table names are filled in.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.text import risk_band
from holdfast.sources.schema import PREDICTION_COLUMNS, REGISTRY_SCHEMA

RAW_SQL = """
WITH h AS (
  SELECT o_custkey AS k, MIN(o_orderdate) AS first_o, MAX(o_orderdate) AS last_o
  FROM {orders} GROUP BY o_custkey),
b AS (
  SELECT c.c_custkey AS k, c.c_nationkey AS nk,
         CASE WHEN c.c_mktsegment IN ('AUTOMOBILE','BUILDING') THEN 0
              WHEN c.c_mktsegment IN ('FURNITURE','HOUSEHOLD') THEN 1 ELSE 2 END AS ct,
         CAST(ROUND(ABS(c.c_acctbal) * 1e2) AS BIGINT) % 10000 + 1825 AS mc,
         COALESCE((2001 - YEAR(h.first_o)) * 12 + 8 - MONTH(h.first_o), 0) AS t0,
         COALESCE(YEAR(h.last_o) * 100 + MONTH(h.last_o), 0) AS last_ym
  FROM {customer} c LEFT JOIN h ON h.k = c.c_custkey),
t AS (
  SELECT *, CASE WHEN k % 2 = 0 THEN (k * 7) % (t0 + 1) ELSE t0 END AS tm,
         CASE WHEN k % 5 = 0 THEN 0 WHEN k % 5 <= 2 THEN 1 ELSE 2 END AS inet
  FROM b),
u AS (
  SELECT *, mc * tm * (90 + k % 21) AS tc100,
         CASE WHEN last_ym < CASE ct WHEN 0 THEN 200106 WHEN 1 THEN 200101 ELSE 200005 END
              THEN 'Yes' ELSE 'No' END AS churn
  FROM t)
SELECT CONCAT('S', CAST(k AS STRING)) AS customer_id,
  CASE WHEN k % 2 = 1 THEN 'Male' ELSE 'Female' END AS gender,
  CASE WHEN nk % 6 = 0 THEN 'Yes' ELSE 'No' END AS senior_citizen,
  CASE WHEN (k * 31) % 100 < 48 THEN 'Yes' ELSE 'No' END AS partner,
  CASE WHEN (k * 37) % 100 < 30 THEN 'Yes' ELSE 'No' END AS dependents,
  CAST(tm AS BIGINT) AS tenure_months,
  CASE WHEN k % 10 = 0 THEN 'No' ELSE 'Yes' END AS phone_service,
  CASE WHEN k % 10 = 0 THEN 'No phone service' WHEN (k * 41) % 100 < 42 THEN 'Yes' ELSE 'No' END AS multiple_lines,
  CASE inet WHEN 0 THEN 'No' WHEN 1 THEN 'DSL' ELSE 'Fiber optic' END AS internet_service,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 43) % 100 < 29 THEN 'Yes' ELSE 'No' END AS online_security,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 47) % 100 < 34 THEN 'Yes' ELSE 'No' END AS online_backup,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 53) % 100 < 34 THEN 'Yes' ELSE 'No' END AS device_protection,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 59) % 100 < 29 THEN 'Yes' ELSE 'No' END AS tech_support,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 61) % 100 < 38 THEN 'Yes' ELSE 'No' END AS streaming_tv,
  CASE WHEN inet = 0 THEN 'No internet service' WHEN (k * 67) % 100 < 39 THEN 'Yes' ELSE 'No' END AS streaming_movies,
  CASE ct WHEN 0 THEN 'Month-to-month' WHEN 1 THEN 'One year' ELSE 'Two year' END AS contract,
  CASE WHEN (k * 71) % 100 < 59 THEN 'Yes' ELSE 'No' END AS paperless_billing,
  CASE nk % 4 WHEN 0 THEN 'Electronic check' WHEN 1 THEN 'Mailed check'
       WHEN 2 THEN 'Bank transfer (automatic)' ELSE 'Credit card (automatic)' END AS payment_method,
  mc / 1e2 AS monthly_charges,
  CASE WHEN tm = 0 THEN ' '
       ELSE CONCAT(CAST((tc100 - tc100 % 10000) / 10000 AS BIGINT), '.',
                   LPAD(CAST(CAST((tc100 % 10000 - tc100 % 100) / 100 AS BIGINT) AS STRING), 2, '0')) END AS total_charges,
  churn AS churn_label,
  CASE WHEN churn = 'Yes' THEN 'Competitor' END AS churn_reason
FROM u
"""

# Number, run id, model name and training time of the registered runs.
RUNS = [
    (1, "r1", "logreg", "2026-01-01T00:00:00Z"),
    (2, "r2", "xgboost", "2026-01-02T00:00:00Z"),
    (3, "r3", "rf_calibrated", "2026-01-03T00:00:00Z"),
    (4, "r4", "xgb_calibrated", "2026-01-04T00:00:00Z"),
    (5, "r5", "tf_mlp", "2026-01-05T00:00:00Z"),
]
UNSCORED_RUNS = ["r5"]


def raw_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per customer, 21 required columns and one leakage column."""
    customer = spark.read.parquet(f"{sf_dir}/customer.parquet")
    orders = spark.read.parquet(f"{sf_dir}/orders.parquet")
    return spark.sql(RAW_SQL, customer=customer, orders=orders)


#: Faults by column: every so many customers one value goes wrong.
FAULTS = {
    "gender": "CASE WHEN k % 41 = 0 THEN 'Unknown' ELSE gender END",
    "senior_citizen": "CASE WHEN k % 37 = 0 THEN NULL ELSE senior_citizen END",
    "tenure_months": "CASE WHEN k % 43 = 0 THEN -1 WHEN k % 47 = 0 THEN 201 ELSE tenure_months END",
    "contract": "CASE WHEN k % 53 = 0 THEN 'Weekly' ELSE contract END",
    "monthly_charges": "CASE WHEN k % 59 = 0 THEN 0e0 WHEN k % 31 = 0 THEN NULL ELSE monthly_charges END",
    "total_charges": "CASE WHEN k % 29 = 0 THEN ' ' WHEN k % 23 = 0 THEN 'abc' ELSE total_charges END",
    "churn_label": "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 61 = 0 THEN 'Maybe' ELSE churn_label END",
}


def faulty_sql(columns: list[str], source: str) -> str:
    """Query over a raw table that injects the faults and repeats some customers."""
    listed = ", ".join(f"{FAULTS[c]} AS {c}" if c in FAULTS else c for c in columns)
    keyed = f"(SELECT *, CAST(substr(customer_id, 2) AS BIGINT) AS k FROM {source}) AS s"
    return f"SELECT {listed} FROM {keyed} UNION ALL SELECT {listed} FROM {keyed} WHERE k % 17 = 0"


def faulty_subscribers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The raw table with faults, so that checks have something to find."""
    raw = raw_subscribers(spark, sf_dir)
    return spark.sql(faulty_sql(raw.columns, "{raw}"), raw=raw)


#: Faults of the stored tables by column, as conditions on the subscriber's number. The parent also lacks some rows.
STAR_FAULTS = {
    "dim_subscriber": {
        "subscriber_id": "CASE WHEN k % 89 = 0 THEN NULL ELSE subscriber_id END",
        "gender": "CASE WHEN k % 41 = 0 THEN 'Unknown' WHEN k % 43 = 0 THEN NULL ELSE gender END",
        "tenure_months": "CASE WHEN k % 47 = 0 THEN -1 ELSE tenure_months END",
        "is_new_subscriber": "CASE WHEN k % 53 = 0 THEN 2 ELSE is_new_subscriber END",
    },
    "dim_service_profile": {
        "internet_service": "CASE WHEN k % 37 = 0 THEN 'Cable' ELSE internet_service END",
        "services_count": "CASE WHEN k % 59 = 0 THEN -2 ELSE services_count END",
    },
    "dim_contract": {
        "subscriber_id": "CASE WHEN k % 71 = 0 THEN NULL ELSE subscriber_id END",
        "contract_type": "CASE WHEN k % 31 = 0 THEN 'Weekly' ELSE contract_type END",
        "contract_commitment_months": "CASE WHEN k % 29 = 0 THEN 7 ELSE contract_commitment_months END",
    },
    "fact_billing": {
        "monthly_charge": "CASE WHEN k % 23 = 0 THEN 0e0 ELSE monthly_charge END",
        "lifetime_billed": "CASE WHEN k % 61 = 0 THEN -1e0 WHEN k % 67 = 0 THEN NULL ELSE lifetime_billed END",
    },
    "fact_attrition_label": {"churned_flag": "CASE WHEN k % 19 = 0 THEN NULL WHEN k % 73 = 0 THEN 3 ELSE churned_flag END"},
    "fact_prediction": {
        "risk_score": "CASE WHEN k % 79 = 0 THEN 12e-1 WHEN k % 83 = 0 THEN NULL ELSE risk_score END",
        "risk_band": "CASE WHEN k % 97 = 0 THEN 'Severe' ELSE risk_band END",
    },
    "model_run": {"trained_at": "CASE WHEN run_id = 'r2' THEN NULL ELSE trained_at END"},
}


def faulty_star_sql(table: str, columns: list[str], source: str) -> str:
    """Query over a stored table that injects its faults, repeats some rows and leaves out some parents."""
    faults = STAR_FAULTS[table]
    listed = ", ".join(f"{faults[c]} AS {c}" if c in faults else c for c in columns)
    if table == "model_run":
        return f"SELECT {listed} FROM {source} AS r UNION ALL SELECT {listed} FROM {source} AS r WHERE run_id = 'r1'"
    keyed = f"(SELECT *, CAST(substr(subscriber_id, 2) AS BIGINT) AS k FROM {source} AS t) AS s"
    kept = " WHERE k % 101 <> 0" if table == "dim_subscriber" else ""
    return f"SELECT {listed} FROM {keyed}{kept} UNION ALL SELECT {listed} FROM {keyed} WHERE k % 17 = 0"


def faulty_star(tables: dict[str, DataFrame]) -> dict[str, DataFrame]:
    """The stored tables with faults, so that every kind of rule is broken somewhere."""
    return {
        name: df.sparkSession.sql(faulty_star_sql(name, df.columns, "{source}"), source=df) for name, df in tables.items()
    }


def predictions(subscribers: DataFrame) -> DataFrame:
    """Scores of four runs per subscriber: deterministic, four decimals, related to the label, with ties.

    The runs come from an array literal, so a row fans out to four without any join.
    """
    runs = F.array(
        *[
            F.struct(F.lit(n).cast("bigint").alias("n"), F.lit(run).alias("run_id"), F.lit(model).alias("model_name"))
            for n, run, model, _ in RUNS
            if run not in UNSCORED_RUNS
        ]
    )
    number = F.substring("subscriber_id", 2, 18).cast("bigint")
    lift = F.when(F.col("churned_flag") == 1, 3500).otherwise(0)
    score = (lift + (number * 7919 + F.col("n") * 4801) % 6500) / F.lit(1e4)
    return (
        subscribers.select("subscriber_id", "churned_flag", F.inline(runs))
        .withColumn("risk_score", score)
        .withColumn("risk_band", risk_band(F.col("risk_score")))
        .withColumn("predicted_flag", (F.col("risk_score") >= 0.5).cast("int"))
        .select(*PREDICTION_COLUMNS)
    )


def registry(spark: SparkSession) -> DataFrame:
    """Run registry: identity of each run; its metric columns stay empty until they are computed."""
    rows = [(run, model, at, 42) + (None,) * 10 + (0.5, None) for _, run, model, at in RUNS]
    return spark.createDataFrame(rows, REGISTRY_SCHEMA)
