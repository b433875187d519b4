import random
import zlib

import pytest
from pyspark.sql import functions as F

from holdfast.llm import rule_ensemble as re_
from holdfast.llm.common import table


def test_statistics():
    s = dict(zip(re_.STATISTICS, re_.statistics(b"The CAT! | the the\nx x x\nx x x\n")))
    assert s["word_length"] == pytest.approx(20 / 11) and s["upper_share"] == pytest.approx(4 / 18)
    assert s["exclaim_share"] == s["pipe_share"] == pytest.approx(1 / 20)
    assert s["distinct_share"] == pytest.approx(5 / 11) and s["top_word_share"] == pytest.approx(6 / 11)
    assert s["dup_line_share"] == pytest.approx(1 / 3) and s["same_next_share"] == pytest.approx(6 / 11)
    assert re_.statistics(b" \n") == (0.0,) * len(re_.STATISTICS)
    re_.statistics(b"word " * 300_000)


def test_paths_become_rules():
    text = """RandomForestClassificationModel
  Tree 0 (weight 1.0):
    If (feature 3 <= 0.5)
     If (feature 3 <= 0.25)
      Predict: 0.0
     Else (feature 3 > 0.25)
      Predict: 1.0
    Else (feature 3 > 0.5)
     If (feature 1 <= 2.0E-4)
      Predict: 0.0
     Else (feature 1 > 2.0E-4)
      Predict: 1.0
  Tree 1 (weight 1.0):
    If (feature 3 <= 0.5)
     Predict: 0.0
    Else (feature 3 > 0.5)
     Predict: 1.0
"""
    inf = float("inf")
    assert re_.rules_of(text) == [
        ((3, -inf, 0.5),), ((3, -inf, 0.25),), ((3, 0.25, 0.5),), ((3, 0.5, inf),), ((1, -inf, 2e-4), (3, 0.5, inf)), ((1, 2e-4, inf), (3, 0.5, inf)),
    ]


def test_held_out_accuracy(spark):
    folder = "/root/testdata/sf0.1"
    docs, labels = table(spark, folder, "documents"), table(spark, folder, "labels")
    scored = re_.quality_scores(docs, labels)
    assert scored.count() == docs.count() and scored.where("score < 0 or score > 1 or score is null").count() == 0
    rows = scored.join(labels, "doc_id").where("held_out").collect()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows) and len(rows) > 500
    right = [r.predicted == r.quality for r in rows]
    assert sum(right) / len(right) > 0.97
    low = [r.predicted == 0 for r in rows if r.quality == 0]
    assert sum(low) / len(low) > 0.9


def test_score_is_the_sum_of_the_rules(spark):
    model = re_.RuleModel(0.5, [(((1, 2.0, float("inf")),), 1.0), (((0, 0.0, 1.0), (2, float("-inf"), 0.5)), -2.0)])
    row = {s: 0.0 for s in re_.STATISTICS} | {"log_words": 0.7, "word_length": 3.0}
    got = spark.createDataFrame([row]).select(model.score()).first()[0]
    assert got == pytest.approx(1 / (1 + 2.718281828459045**0.5))
    assert len(model.describe()) == 2


def test_odd_rows(spark):
    rng = random.Random(1)
    rows = [(i, " ".join(rng.choice("abc") * (i % 3 + 1) for _ in range(20)), 0) for i in range(60)] + [(None, None, 1), (1, "", 1), (2, None, 1), (2, "b", 1)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, label int")
    labels = spark.createDataFrame([(i, i % 2) for i in range(50)] + [(3, 0), (51, None), (None, 1)], "doc_id long, quality int")
    got = re_.quality_scores(docs, labels)
    assert got.count() == len(rows) and got.where("score is null or held_out is null").count() == 0
    none = re_.quality_scores(docs, labels.limit(0)).select(F.min("score"), F.max("score")).first()
    assert tuple(none) == (0.5, 0.5)
    ones = labels.where("quality = 1 and doc_id <> 3")
    assert re_.quality_scores(docs, ones).where("score <= 0.5").count() == 0
    assert re_.quality_scores(docs.limit(0), labels).count() == 0


def test_the_model_does_not_depend_on_the_partitioning(spark):
    docs, labels = (table(spark, "/root/testdata/sf0.001", t) for t in ("documents", "labels"))
    rows = re_.labelled(re_.measured(docs), labels).persist()
    models = [re_.fit(x) for x in (rows.orderBy("label").coalesce(1), rows.repartition(7))]
    assert models[0] == models[1] and models[0].rules
