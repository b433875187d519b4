"""Figures that must hold far beyond the size of the test data."""

import math

import pytest
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_away
from holdfast.operators.prefix import running_totals
from holdfast.plans.contingency import chi_square
from holdfast.plans.numeric import moments
from holdfast.plans.reports import command_center_kpis
from holdfast.sources.tables import fingerprint


def test_rounding_does_not_saturate(spark):
    values = [1e13, 5e13, 9.3e12, -1e13, 4e18, 2.5, -2.5, 0.125, 0.0, 1e300, None]
    rows = spark.createDataFrame([(v,) for v in values], "x double")
    got = [r[0] for r in rows.select(half_away(F.col("x"), 6)).collect()]
    assert got == values
    assert [r[0] for r in rows.select(half_away(F.col("x"), 0)).collect()][5:8] == [3.0, -3.0, 0.0]


def test_chi_square_of_billions_of_rows(spark):
    n = 4_000_000_000
    table = spark.createDataFrame([("f", "a", n, n // 2), ("f", "b", n, n // 4)], "feature string, value string, n long, k long")
    expected = n * (3 * n / 4) / (2 * n)
    gap = n / 2 - expected - 0.5
    want = 2 * gap * gap * (1 / expected + 1 / (n - expected))
    assert chi_square(table).first().chi2 == pytest.approx(want)


def test_means_keep_all_digits(spark):
    rows = spark.createDataFrame([("f", 0.004, 1), ("f", 0.004, 1), ("f", 0.0012, 0), ("f", 0.0014, 0)], "feature string, value double, label int")
    got = moments(rows).first()
    assert got.mean_churned == pytest.approx(0.004) and got.mean_retained == pytest.approx(0.0013)


def test_fingerprint_tells_rows_apart(spark):
    rows = [("a|b", "c", 1.001), ("a", "b|c", 1.001), ("a|b", "c", 1.004), (None, "c", 1.0), ("~", "c", 1.0), ("-", "c", 1.0), ("", "c", 1.0), ("x", "y", math.nan), ("x", "y", None), ("1:x", "", 0.0), ("", "1:x", 0.0)]
    sums = {fingerprint(spark.createDataFrame([r], "a string, b string, c double")).first().content_sum for r in rows}
    assert len(sums) == len(rows)
    table = spark.createDataFrame(rows, "a string, b string, c double")
    assert fingerprint(table).first() == fingerprint(table.orderBy(F.rand()).repartition(3)).first()


def test_slices_follow_the_shuffle_width(spark):
    rows = spark.range(3000).select(F.lit("k").alias("k"), (F.col("id") * 7 % 3001).cast("double").alias("v"), F.lit(1).alias("n"))
    before, found = spark.conf.get("spark.sql.shuffle.partitions"), []
    try:
        for width in (4, 300):
            spark.conf.set("spark.sql.shuffle.partitions", width)
            found.append(running_totals(rows, ["k"], "v", ["n"]).orderBy("v").select("n_below").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert found[0] == found[1] and [r.n_below for r in found[0]] == list(range(3000))


def test_watchlist_count_has_no_cap(wh, monkeypatch):
    many = wh.watchlist_scores().withColumn("again", F.explode(F.sequence(F.lit(1), F.lit(20))))
    monkeypatch.setattr(type(wh), "watchlist_scores", lambda self: many)
    assert command_center_kpis(wh).first().watchlist_count == many.count() > 500
