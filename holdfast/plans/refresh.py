"""The ordered refresh: land, validate, build, check, train, register, score, store, apply the computed cut-offs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.functions.text import risk_band
from holdfast.operators.clean import clean
from holdfast.operators.features import add_features
from holdfast.operators.quality import assert_constraints, validation_report
from holdfast.plans import training
from holdfast.plans.metrics import optimal_threshold
from holdfast.plans.reports import table_row_counts
from holdfast.plans.warehouse import KEY, TABLES, Warehouse, build
from holdfast.sources.schema import PREDICTION_COLUMNS, REGISTRY_SCHEMA, STAR
from holdfast.sources.tables import land

_NO_PREDICTIONS = "run_id string, subscriber_id string, model_name string, risk_score double, risk_band string, predicted_flag int"


def assert_valid(raw: DataFrame) -> None:
    """Raise if a critical check of the raw table fails. Only the failed checks reach the driver."""
    failed = validation_report(raw).filter("status = 'FAIL_CRITICAL'").select("check").collect()
    if failed:
        raise ValueError("; ".join(r["check"] for r in failed))


def assert_counts(wh: Warehouse, expected: int) -> None:
    """Raise unless every star table holds one row per subscriber of the feature table."""
    wrong = table_row_counts(wh).filter(F.col("table_name").isin(list(STAR)) & (F.col("row_count") != expected)).collect()
    if wrong:
        raise ValueError("; ".join(f"{r.table_name}: {r.row_count} rows, expected {expected}" for r in wrong))


def load(spark: SparkSession, raw: DataFrame, namespace: str, n_buckets: int | None = None) -> Warehouse:
    """Validate, clean and store ``raw`` as a star schema without predictions, and check what was stored."""
    assert_valid(raw)
    none = spark.createDataFrame([], _NO_PREDICTIONS)
    registry = spark.createDataFrame([], REGISTRY_SCHEMA)
    wh = build(spark, add_features(clean(raw)), lambda _: none, registry, namespace, n_buckets)
    assert_counts(wh, wh.table("features").select(KEY).distinct().count())
    assert_constraints({name: wh.table(name) for name in TABLES})
    return wh


def apply_cutoffs(wh: Warehouse, runs: DataFrame) -> None:
    """Band the stored scores of ``runs`` by the cut-offs that follow from the value and F1 searches."""
    cutoffs = optimal_threshold(wh, runs).select("run_id", "high_cutoff", "medium_cutoff")
    scores = wh.table("fact_prediction").join(cutoffs, "run_id")
    banded = scores.withColumn("risk_band", risk_band(F.col("risk_score"), F.col("high_cutoff"), F.col("medium_cutoff")))
    wh.upsert_predictions(banded.select(*PREDICTION_COLUMNS))


def train_and_store(wh: Warehouse, trained_at: str, **options) -> DataFrame:
    """Train, register and store the scores of one training beside those of earlier ones; its registry rows."""
    runs = training.train(wh, trained_at, **options)
    training.register(wh, runs)
    wh.upsert_predictions(training.score_all(wh, runs))
    apply_cutoffs(wh, runs)
    return runs


def refresh(spark: SparkSession, source: str, landing: str, namespace: str, trained_at: str, **options) -> Warehouse:
    """The whole chain from raw CSV files to reports on trained scores. A critical finding or a broken constraint
    stops it with an error."""
    wh = load(spark, land(spark, source, landing), namespace)
    train_and_store(wh, trained_at, **options)
    return wh
