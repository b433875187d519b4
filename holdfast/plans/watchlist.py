"""Watchlist pages, the retention planner and the run leaderboard."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.functions.rounding import half_away, half_even, money_avg, money_sum, ratio
from holdfast.plans.metrics import classification_metrics
from holdfast.plans.warehouse import KEY, Warehouse

# Planner cohort cut, planner defaults, offer defaults and the grid of the planner sliders.
COHORT_CUT = 0.42
OFFER_COST, SAVE_RATE_PERCENT, HORIZON = 18.5, 22.0, 12
OFFER_COST_GRID = (10, 200, 5)
SAVE_PERCENT_GRID = (5, 60, 1)
HORIZON_GRID = (3, 36, 1)

ROW_COLUMNS = [
    KEY, "risk_score", "risk_band", "monthly_charge", "tenure_months", "contract_type", "payment_method",
    "is_autopay", "churned_flag",
]


def call_list(wh: Warehouse, top: int = 500, skip: int = 0) -> DataFrame:
    """The highest-risk rows of the watchlist, in order."""
    return wh.scored_watchlist(top, skip).orderBy(F.desc("risk_score"), KEY)


def top_risk_preview(wh: Warehouse, top: int = 3) -> DataFrame:
    return call_list(wh, top).select(
        KEY, "contract_type", "tenure_months", "monthly_charge", "risk_score", "risk_band", "payment_method"
    )


def ranked_scores(wh: Warehouse) -> DataFrame:
    """Scores of the preferred run, stored in slices by rank: every row of a slice ranks before those of the next one. Ties
    are parted by the id, so a score that very many rows share does not stay in one slice."""

    def plan() -> DataFrame:
        n = int(wh.spark.conf.get("spark.sql.shuffle.partitions"))
        sliced = wh.watchlist_scores().repartitionByRange(n, F.desc("risk_score"), KEY)
        return sliced.withColumn("slice", F.spark_partition_id())

    return wh.derived("ranked_scores", plan, "slice")


def rank_directory(wh: Warehouse) -> DataFrame:
    """Per slice of the ranked scores its rows and the rank of its first one, counted from 0."""

    def plan() -> DataFrame:
        before = W.orderBy("slice").rowsBetween(W.unboundedPreceding, -1)  # one row per slice
        sizes = ranked_scores(wh).groupBy("slice").agg(F.count("*").alias("n_rows"))
        first = F.coalesce(F.sum("n_rows").over(before), F.lit(0)).alias("first_rank")
        return sizes.select("n_rows", first, F.col("slice").alias("rank_slice"), F.lit(0).alias("part"))

    return wh.derived("rank_directory", plan, "part")


def _ranks(wh: Warehouse, start: int, n: int) -> DataFrame:
    """Rows of ranks ``start`` to ``start + n - 1``, from the slices that hold them."""
    hit = (F.col("first_rank") < start + n) & (F.col("first_rank") + F.col("n_rows") > start)
    found = rank_directory(wh).filter(hit).select("rank_slice", "first_rank").collect()  # slices of one page
    first = min((r.first_rank for r in found), default=0)
    rows = ranked_scores(wh).filter(F.col("slice").isin([r.rank_slice for r in found])).drop("slice")
    return rows.orderBy(F.desc("risk_score"), KEY).offset(start - first if found else 0).limit(n)


def watchlist_page(
    wh: Warehouse, page: int = 1, per_page: int = 6, after: tuple[float, str] | None = None
) -> DataFrame:
    """One page of the ranked watchlist with the total and the number of pages.

    A page number reads only the slices of the ranked scores that the rank directory names for it, so it costs the same at any
    depth. With ``after``, the score and id of the last row seen, the page starts behind that row and needs no ranking.
    A page without rows is one row that holds the totals alone.
    """
    if after is None:
        totals = rank_directory(wh).agg(F.coalesce(F.sum("n_rows"), F.lit(0)).alias("total"))
        rows = wh.with_profile(_ranks(wh, (page - 1) * per_page, per_page))
    else:
        totals = wh.watchlist_scores().agg(F.count("*").alias("total"))
        rows = wh.scored_watchlist(per_page, after=after)
    pages = F.greatest(F.lit(1), F.ceil(F.col("total") / per_page)).cast("bigint")
    on_page = rows.select(*ROW_COLUMNS).withColumn("total", totals.scalar())
    return (
        totals.join(on_page, "total", "left")
        .select(*ROW_COLUMNS, "total", pages.alias("total_pages"))
        .orderBy(F.desc("risk_score"), KEY)
    )


def _charged(wh: Warehouse) -> DataFrame:
    """Watchlist scores with the monthly charge: all that the sums over the list read."""
    return wh.watchlist_scores().join(wh.table("fact_billing").select(KEY, "monthly_charge"), KEY)


def watchlist_kpi(wh: Warehouse) -> DataFrame:
    charge = F.col("monthly_charge")
    return _charged(wh).agg(
        F.count("*").alias("count"),
        half_away(money_sum(charge) * 12, 2).alias("arr"),
        half_away(money_avg(charge) * 12, 2).alias("avg_arr"),
    )


def watchlist_detail(wh: Warehouse, subscriber_id: str | None = None) -> DataFrame:
    """Watchlist row and profile of one subscriber; without an id, of the first row of the list.

    A given id reaches all scans as a filter on the bucket column, so one bucket per table is read.
    """
    extra = [
        "gender", "has_partner", "has_dependents", "internet_service", "services_count", "online_security",
        "tech_support", "streaming_tv", "streaming_movies",
    ]
    profile = wh.star("dim_subscriber", "dim_service_profile").select(KEY, *extra)
    if subscriber_id is None:
        return wh.scored_watchlist(top=1).join(profile, KEY)
    return wh.scored_watchlist().filter(F.col(KEY) == subscriber_id).join(profile, KEY)


def _plan(cost: Column, percent: Column, horizon: Column, n: Column, average: Column) -> dict[str, Column]:
    budget = half_even(n * cost, 2)
    saves = F.rint(n * (percent / 100)).cast("bigint")
    saved = half_even(saves * average, 2)
    net = half_even(saved * horizon - budget, 2)
    return {
        "outreach_budget": budget,
        "expected_saves": saves,
        "gross_saved_mrr": saved,
        "net_impact": net,
        "roi": F.when(budget > 0, half_even(F.try_divide(net, budget), 1)).otherwise(0.0),
    }


def _cohort(wh: Warehouse) -> DataFrame:
    """Size and average charge of the subscribers above the planner's cut. One row."""
    return (
        _charged(wh)
        .filter(F.col("risk_score") >= COHORT_CUT)
        .agg(F.count("*").alias("cohort_count"), money_avg(F.col("monthly_charge")).alias("avg_mrr"))
    )


def retention_plan(
    wh: Warehouse, offer_cost: float = OFFER_COST, save_rate: float = SAVE_RATE_PERCENT, horizon: int = HORIZON
) -> DataFrame:
    """Budget, saves and return of one offer. An empty cohort gives 0 and NULL, never a stand-in value."""
    figures = _plan(
        F.lit(float(offer_cost)), F.lit(float(save_rate)), F.lit(horizon), F.col("cohort_count"), F.col("avg_mrr")
    )
    return (
        _cohort(wh)
        .select("*", *[c.alias(name) for name, c in figures.items()])
        .withColumn("optimal_threshold", F.lit(COHORT_CUT))
    )


def retention_plan_grid(wh: Warehouse, mode: str = "planner") -> DataFrame:
    """The plan for every point of the slider grid: the one cohort row is fanned out by sequences.

    ``mode="assumption"`` uses the plainer value rule contacts * save rate * average charge * horizon - cost,
    without rounding the number of saves.
    """
    grid = (
        _cohort(wh)
        .withColumn("offer_cost", F.explode(F.sequence(*[F.lit(v) for v in OFFER_COST_GRID])))
        .withColumn("save_percent", F.explode(F.sequence(*[F.lit(v) for v in SAVE_PERCENT_GRID])))
        .withColumn("horizon_months", F.explode(F.sequence(*[F.lit(v) for v in HORIZON_GRID])))
    )
    cost, percent = F.col("offer_cost").cast("double"), F.col("save_percent").cast("double")
    n, average, horizon = F.col("cohort_count"), F.col("avg_mrr"), F.col("horizon_months")
    keys = ["offer_cost", "save_percent", "horizon_months"]
    if mode == "assumption":
        value = n * (percent / 100) * average * horizon - n * cost
        return grid.select(*keys, half_even(value, 2).alias("net_value"))
    if mode != "planner":
        raise ValueError(f"unknown mode {mode}")
    return grid.select(*keys, *[c.alias(k) for k, c in _plan(cost, percent, horizon, n, average).items()])


def model_leaderboard(wh: Warehouse) -> DataFrame:
    """Registered runs, newest first. A metric the trainer did not record is computed from the stored
    predictions and labels; a run without predictions keeps NULL."""
    measured = classification_metrics(wh).select(
        "run_id",
        F.col("roc_auc").alias("m_auc"),
        F.col("precision").alias("m_precision"),
        F.col("recall").alias("m_recall"),
        F.col("f1").alias("m_f1"),
    )
    return (
        wh.table("model_run")
        .join(measured, "run_id", "left")
        .select(
            "run_id",
            "model_name",
            F.coalesce("test_auc", "m_auc").alias("test_auc"),
            F.coalesce("test_precision", "m_precision").alias("test_precision"),
            F.coalesce("test_recall", "m_recall").alias("test_recall"),
            F.coalesce("test_f1", "m_f1").alias("test_f1"),
            "trained_at",
        )
        .orderBy(F.desc("trained_at"))
    )
