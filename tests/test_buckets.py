"""Upserts follow the buckets of the stored table, and an empty registry scores nothing."""

import glob
import re

from pyspark.sql import functions as F

from holdfast.plans import training
from holdfast.plans.warehouse import build
from holdfast.sources import fixture
from holdfast.sources.schema import PREDICTION_COLUMNS
from holdfast.operators.clean import clean
from holdfast.operators.features import add_features
from tests.conftest import SMALL


def test_an_upsert_writes_one_file_for_each_bucket_of_the_table(spark):
    features = add_features(clean(fixture.raw_subscribers(spark, SMALL)))
    wh = build(spark, features, fixture.predictions, fixture.registry(spark), "holdfast_buckets", n_buckets=3)
    assert wh.n_buckets("fact_prediction") == 3 != int(spark.conf.get("spark.sql.shuffle.partitions"))
    before = wh.table("fact_prediction").count()
    run = wh.table("model_run").first().run_id
    new = wh.table("fact_prediction").filter(F.col("run_id") == run).withColumn("risk_score", F.lit(0.125)).select(*PREDICTION_COLUMNS)
    wh.upsert_predictions(new)
    stored = wh.table("fact_prediction")
    mine = stored.filter(F.col("run_id") == run)
    assert stored.count() == before and mine.filter("risk_score = 0.125").count() == mine.count() > 0
    files = [r.f for r in mine.select(F.input_file_name().alias("f")).distinct().collect()]
    folder = re.sub(r"^file:/*", "/", files[0].rsplit("/", 1)[0])
    assert len(glob.glob(f"{folder}/*.parquet")) <= 3


def test_an_empty_registry_scores_nothing(wh):
    none = training.score_all(wh, wh.table("model_run").limit(0))
    assert none.columns == PREDICTION_COLUMNS and none.collect() == []
