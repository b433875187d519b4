"""The learners with the default parameters of ``train``, measured on the held-out rows."""

import inspect
import time

import pytest
from pyspark.ml.evaluation import BinaryClassificationEvaluator
from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from holdfast.plans import training
from holdfast.plans.warehouse import open_warehouse

DEFAULTS = {k: p.default for k, p in inspect.signature(training.train).parameters.items()}


def test_defaults_cut_neither_rounds_nor_depth():
    assert (DEFAULTS["trees"], DEFAULTS["tree_depth"], DEFAULTS["rounds"]) == (100, 30, 100)


@pytest.mark.parametrize("name", ["random_forest", "xgboost"])
def test_default_learners_are_whole_and_beat_the_floor(spark, name):
    rows = training.model_rows(open_warehouse(spark, "/root/testdata/sf0.01"))
    n = rows.filter("NOT held_out").count()
    positives = rows.filter("NOT held_out AND label = 1").count()
    prepared = training.preparation().fit(rows.filter("NOT held_out"))
    balance = F.when(F.col("label") == 1, n / (2.0 * positives)).otherwise(n / (2.0 * (n - positives)))
    boost = F.when(F.col("label") == 1, training.BOOST_WEIGHT).otherwise(1.0)
    data = prepared.transform(rows).select("label", "held_out", "features", balance.alias("balance"), boost.alias("boost")).coalesce(2).persist()

    def measured(depth, rounds):
        began = time.perf_counter()
        model = training._learners(n, DEFAULTS["trees"], depth, rounds)[name].fit(data.filter("NOT held_out"))
        took = time.perf_counter() - began
        scored = model.transform(data.filter("held_out")).withColumn("p", vector_to_array("probability")[1])
        p = F.least(F.greatest("p", F.lit(1e-15)), F.lit(1 - 1e-15))
        loss = scored.agg(F.avg(-F.log(F.when(F.col("label") == 1, p).otherwise(1 - p)))).first()[0]
        auc = BinaryClassificationEvaluator().evaluate(scored)
        print(f"{name} depth {depth} rounds {rounds}: AUC {auc:.4f} log loss {loss:.4f}, fit {took:.1f} s, deepest {max(t.depth for t in model.trees)}", flush=True)
        return model, auc

    measured(8, 20)
    model, auc = measured(DEFAULTS["tree_depth"], DEFAULTS["rounds"])
    assert auc > 0.7
    if name == "random_forest":
        assert max(t.depth for t in model.trees) > 8
    else:
        assert len(model.trees) == 100
    data.unpersist()
