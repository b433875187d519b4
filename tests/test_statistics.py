"""Closed-form checks of the statistics on published marginals and brute force."""

import math
import random
import statistics

import pytest
from pyspark.sql import functions as F

from holdfast.functions.tails import chi2_tail, student_two_sided
from holdfast.operators.prefix import running_totals
from holdfast.plans.contingency import chi_square
from holdfast.plans.metrics import ranking_metrics, score_histogram
from holdfast.plans.numeric import poisson_thresholds, resample_totals, two_group_figures
from holdfast.plans.survival import curves


def test_chi_square_of_contract(spark):
    rows = [
        ("contract_type", "Month-to-month", 3875, 1655),
        ("contract_type", "One year", 1473, 166),
        ("contract_type", "Two year", 1695, 48),
    ]
    got = chi_square(spark.createDataFrame(rows, "feature string, value string, n bigint, k bigint")).first()
    assert got.chi2 == pytest.approx(1184.5966, abs=1e-4)
    assert got.dof == 2
    assert got.v == pytest.approx(0.4101, abs=5e-5)


def test_chi_square_without_any_positive_row(spark):
    rows = [("f", "a", 5, 0), ("f", "b", 7, 0)]
    got = chi_square(spark.createDataFrame(rows, "feature string, value string, n bigint, k bigint")).first()
    assert (got.chi2, got.dof, got.p, got.v) == (0.0, 0, 1.0, 0.0)


@pytest.mark.parametrize(
    "moments, t, d, r",
    [
        ((17.979, 37.57, 19.531, 24.114, 2515538.0), -34.82, -0.852, 0.4797),
        ((74.441, 61.265, 24.666, 31.093, 6003125.5), 18.41, 0.446, -0.2416),
    ],
)
def test_two_group_figures(spark, moments, t, d, r):
    row = (1869, 5174, *moments, 0.0)
    names = "n_churned bigint, n_retained bigint, mean_churned double, mean_retained double, std_churned double, "
    names += "std_retained double, u double, ties double"
    got = two_group_figures(spark.createDataFrame([row], names)).first()
    assert got.t == pytest.approx(t, abs=0.01)
    assert got.d == pytest.approx(d, abs=0.001)
    assert got.r == pytest.approx(r, abs=5e-5)


def test_tails_agree_with_a_library(spark):
    commons = spark._jvm.org.apache.commons.math3.distribution
    for x, k in [(0.3, 1), (3.84, 1), (5.99, 2), (7.8, 3), (20.0, 4), (9.0, 5)]:
        assert chi2_tail(x, k) == pytest.approx(1 - commons.ChiSquaredDistribution(float(k)).cumulativeProbability(x), abs=1e-10)
    for t, k in [(0.1, 3.5), (-1.65, 1400.2), (2.5, 30.0), (12.0, 8.0)]:
        expected = 2 * commons.TDistribution(float(k)).cumulativeProbability(-abs(t))
        assert student_two_sided(t, k) == pytest.approx(expected, abs=1e-9)


def test_survival_drops_to_zero_when_all_leave(spark):
    table = spark.createDataFrame(
        [("a", 1.0, 1, 10), ("a", 2.0, 9, 9)], "contract_type string, timeline double, events bigint, at_risk bigint"
    )
    got = {r.timeline: r.survival_prob for r in curves(table).collect()}
    assert got == {0.0: 1.0, 1.0: 0.9, 2.0: 0.0}


@pytest.mark.parametrize("partitions", [1, 5, 16])
def test_running_totals_equal_brute_force(spark, partitions):
    """Many slices, negative values, two keys of very different size."""
    rng = random.Random(3)
    data = {("hot", rng.randint(-4000, 4000) / 7): rng.randint(0, 9) for _ in range(3000)}
    data |= {("cold", float(i)): i for i in range(5)}
    rows = [(k, v, n) for (k, v), n in data.items()]
    hist = spark.createDataFrame(rows, "k string, v double, n bigint").repartition(partitions)
    got = {(r.k, r.v): (r.n_below, r.n_total) for r in running_totals(hist, ["k"], "v", ["n"]).collect()}
    total, expected = {}, {}
    for k, v, n in sorted(rows):
        expected[(k, v)] = total.get(k, 0)
        total[k] = total.get(k, 0) + n
    assert got == {key: (below, total[key[0]]) for key, below in expected.items()}


def test_auc_and_average_precision_with_ties(spark):
    rng = random.Random(5)
    rows = [("m", rng.randint(0, 20) / 20, int(rng.random() < 0.4)) for _ in range(400)]
    scored = spark.createDataFrame(rows, "g string, risk_score double, label int")
    got = ranking_metrics(score_histogram(scored, ["g"]), ["g"]).first()
    pos = [s for _, s, y in rows if y]
    neg = [s for _, s, y in rows if not y]
    auc = sum((p > n) + 0.5 * (p == n) for p in pos for n in neg) / (len(pos) * len(neg))
    ap, seen = 0.0, 0
    for cut in sorted({s for _, s, _ in rows}, reverse=True):
        tp = sum(p >= cut for p in pos)
        ap += (tp - seen) / len(pos) * tp / (tp + sum(n >= cut for n in neg))
        seen = tp
    assert got.roc_auc == pytest.approx(auc, abs=1e-9)
    assert got.pr_auc == pytest.approx(ap, abs=1e-9)


def test_one_class_has_no_auc(spark):
    rows = [("m", 0.1, 1), ("m", 0.2, 1)]
    scored = spark.createDataFrame(rows, "g string, risk_score double, label int")
    got = ranking_metrics(score_histogram(scored, ["g"]), ["g"]).first()
    assert got.roc_auc is None


def test_bootstrap_draws_do_not_depend_on_partitioning(spark):
    rows = [("f", float(v), v % 7 + 1, (v % 5 + 1) * (v % 11)) for v in range(60)]
    hist = spark.createDataFrame(rows, "feature string, value double, pos bigint, neg bigint")

    def draws(n):
        return sorted(map(tuple, resample_totals(hist.repartition(n), 300).collect()))

    one = draws(1)
    assert one == draws(6) and len(one) == 300
    for at, column in ((2, 2), (4, 3)):  # a weight's mean and variance are the number of rows
        weights, n = [r[at] for r in one], sum(r[column] for r in rows)
        assert statistics.mean(weights) == pytest.approx(n, rel=0.02)
        assert statistics.pvariance(weights) == pytest.approx(n, rel=0.3)


def test_poisson_thresholds():
    for rate in (1, 2, 4, 8):
        ends = [0, *poisson_thresholds(rate), 1 << 15]
        shares = [(b - a) / (1 << 15) for a, b in zip(ends, ends[1:])]
        assert shares == pytest.approx([math.exp(-rate) * rate**k / math.factorial(k) for k in range(len(shares))], abs=1e-4)
