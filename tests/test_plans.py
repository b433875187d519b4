"""Plan shape, run choice, sources, sinks and stored upserts."""

import pytest
from pyspark.sql import functions as F

from holdfast.operators.keyed import latest_calibrated_run, of_run, preferred_run
from holdfast.plans import metrics, reports, watchlist
from holdfast.plans.registry import QUERIES, run_query
from holdfast.plans.warehouse import Warehouse, build, open_warehouse
from holdfast.sources import fixture, sinks, tables
from holdfast.sources.schema import HEADER_OF
from tests.conftest import SMALL

FITTED = {"trained_models", "train_and_score", "feature_importance", "odds_ratios"}
ARROW = {"association_tests", "numeric_tests", "vif", "km_summary"}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_no_cross_join_and_no_python_outside_the_known_reports(spark, wh):
    for name, query in QUERIES.items():
        if name in FITTED:
            continue
        text = plan(query(spark, SMALL))
        assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text, name
        if name not in ARROW:
            assert "Python" not in text and "InPandas" not in text, name


def test_star_joins_do_not_shuffle(wh, no_broadcast):
    assert "Exchange" not in plan(wh.subscriber_360())
    assert "Exchange" not in plan(wh.scored_watchlist()).split("Subquery", 1)[0]


def test_top_per_group_is_limited_before_the_exchange(wh, no_broadcast):
    assert "WindowGroupLimit" in plan(reports.top_risk_within_segment(wh))


def test_point_lookup_reads_one_bucket(wh):
    assert "SelectedBucketsCount: 1 out of 4" in plan(watchlist.watchlist_detail(wh, "S1"))


def test_run_choice(spark):
    def runs(*names):
        return spark.createDataFrame(
            [(f"id{i}", n, f"2026-01-0{i + 1}") for i, n in enumerate(names)],
            "run_id string, model_name string, trained_at string",
        )

    assert preferred_run(runs("xgb_calibrated", "rf_calibrated", "xgb_calibrated", "logreg")).first().run_id == "id2"
    assert preferred_run(runs("logreg", "tf_mlp")).first().run_id == "id0"
    assert latest_calibrated_run(runs("xgb_calibrated", "rf_calibrated")).first().run_id == "id1"
    scores = spark.createDataFrame([("id0",)], "run_id string")
    assert of_run(scores, latest_calibrated_run(runs("logreg"))).count() == 0


def test_without_calibrated_run(spark, wh):
    features = spark.table(f"{wh.namespace}.features")
    registry = fixture.registry(spark).filter("run_id NOT IN ('r3', 'r4')")
    bare = build(
        spark, features, lambda f: fixture.predictions(f).filter("run_id NOT IN ('r3', 'r4')"), registry, "holdfast_bare"
    )
    assert reports.revenue_at_risk_by_band(bare).count() == 0
    assert reports.top_risk_within_segment(bare).count() == 0
    assert reports.insights_revenue_at_risk(bare).first().revenue_at_risk == 0.0
    assert watchlist.call_list(bare, 5).first().model_name == "xgboost"


def test_empty_warehouse(spark, wh):
    features = spark.table(f"{wh.namespace}.features").limit(0)
    empty = build(spark, features, fixture.predictions, fixture.registry(spark).limit(0), "holdfast_empty")
    assert reports.kpi_summary(empty).first().total_subscribers == 0
    plan_row = watchlist.retention_plan(empty).first()
    assert plan_row.cohort_count == 0 and plan_row.avg_mrr is None and plan_row.roi == 0.0
    page = watchlist.watchlist_page(empty).collect()
    assert [(r.subscriber_id, r.total, r.total_pages) for r in page] == [(None, 0, 1)]


def test_watchlist_pages(wh):
    by_number = [watchlist.watchlist_page(wh, n, 40).collect() for n in (1, 2, 3, 4, 9)]
    assert [len(p) for p in by_number] == [40, 40, 40, 30, 1]
    assert all((r.total, r.total_pages) == (150, 4) for p in by_number for r in p) and by_number[4][0].subscriber_id is None
    last = by_number[1][-1]
    assert watchlist.watchlist_page(wh, per_page=40, after=(last.risk_score, last.subscriber_id)).collect() == by_number[2]
    end = by_number[3][-1]
    assert [r.total for r in watchlist.watchlist_page(wh, after=(end.risk_score, end.subscriber_id)).collect()] == [150]


def test_sql_of_two_warehouses_side_by_side(spark, wh):
    features = spark.table(f"{wh.namespace}.features").limit(3)
    other = build(spark, features, fixture.predictions, fixture.registry(spark), "holdfast_other")
    text = "SELECT count(*) AS n FROM vw_subscriber_360"
    first, second = wh.sql(text), other.sql(text)
    assert (first.first().n, second.first().n) == (150, 3)
    assert not spark.catalog.tableExists("vw_subscriber_360")


def test_rebuild_gives_new_tables(spark, wh):
    again = open_warehouse(spark, SMALL, rebuild=True)
    assert again.namespace != wh.namespace and again.table("fact_billing").count() == 150


def test_unknown_query_is_an_error(spark):
    with pytest.raises(KeyError, match="unknown query"):
        run_query(spark, SMALL, "nope")


def test_sql_with_bound_parameter(wh):
    got = wh.sql("SELECT count(*) AS n FROM vw_subscriber_360 WHERE subscriber_id = :id", {"id": "S1"}).first()
    assert got.n == 1


def test_csv_round_trip_and_landing(spark, raw, tmp_path):
    headed = raw.select(*[F.col(c).alias(HEADER_OF.get(c, "Churn Reason")) for c in raw.columns])
    sinks.write_csv(headed, f"{tmp_path}/in")
    back = tables.read_raw_csv(spark, f"{tmp_path}/in")
    assert dict(back.dtypes) == dict(raw.dtypes)
    from holdfast.operators.clean import clean

    assert sorted(clean(back).collect()) == sorted(clean(raw).collect())
    landed = tables.land(spark, f"{tmp_path}/in/*.csv", f"{tmp_path}/landed")
    assert landed.count() == tables.land(spark, f"{tmp_path}/in/*.csv", f"{tmp_path}/landed").count() == 150
    with pytest.raises(Exception, match="PATH_NOT_FOUND"):
        tables.land(spark, f"{tmp_path}/none/*.csv", f"{tmp_path}/x")
    assert {len(r.sha256) for r in tables.file_checksums(spark, f"{tmp_path}/in/*.csv").collect()} == {64}
    assert tables.fingerprint(raw).first() == tables.fingerprint(raw.repartition(3)).first()


def test_exports(spark, wh, tmp_path):
    sinks.export_tables({"dim_contract": wh.table("dim_contract")}, f"{tmp_path}/bi")
    assert spark.read.option("header", True).csv(f"{tmp_path}/bi/dim_contract").count() == 150
    sinks.export_call_list(wh.subscriber_360(), wh.scored_watchlist(), f"{tmp_path}/bundle", top=10)
    assert spark.read.option("header", True).csv(f"{tmp_path}/bundle/retention_call_list").count() == 10
    sinks.write_json(reports.insights_document(wh), f"{tmp_path}/doc")
    doc = spark.read.json(f"{tmp_path}/doc").first()
    assert len(doc.contract_insights) == 3 and doc.revenue_at_risk > 0


def test_stored_upsert_rewrites_only_its_run(spark, wh):
    features = spark.table(f"{wh.namespace}.features")
    own = build(spark, features, fixture.predictions, fixture.registry(spark), "holdfast_upsert")
    new = own.table("fact_prediction").filter("run_id = 'r2' AND subscriber_id = 'S1'").withColumn("risk_score", F.lit(0.5))
    mode = spark.conf.get("spark.sql.sources.partitionOverwriteMode")
    own.upsert_predictions(new)
    assert spark.conf.get("spark.sql.sources.partitionOverwriteMode") == mode
    with pytest.raises(Exception, match="several new rows"):
        own.upsert_predictions(new.unionByName(new))
    own.upsert_predictions(new.withColumn("risk_score", F.lit(0.1)).unionByName(new), [F.desc("risk_score")])
    stored = own.table("fact_prediction")
    assert stored.count() == 600
    assert stored.filter("run_id = 'r2' AND subscriber_id = 'S1'").first().risk_score == 0.5
    assert stored.filter("run_id = 'r2'").count() == 150
    assert isinstance(open_warehouse(spark, SMALL), Warehouse)


def test_metrics_and_thresholds_read_the_stored_histogram_only(wh):
    for query in (metrics.classification_metrics, metrics.optimal_threshold):
        text = plan(query(wh))
        assert "fact_prediction" not in text and "fact_billing" not in text and "score_histogram" in text


def test_a_page_reads_the_slices_of_its_ranks(wh):
    ranked = {r.slice: r.n for r in watchlist.ranked_scores(wh).groupBy("slice").agg(F.count("*").alias("n")).collect()}
    assert sum(ranked.values()) == 150 and len(ranked) > 1
    for start in (0, 70, 148):
        rows = watchlist._ranks(wh, start, 2)
        assert rows.count() == 2 and len(rows.inputFiles()) <= 2
        assert "PartitionFilters" in plan(rows) and "fact_prediction" not in plan(rows)


def test_derived_tables_follow_new_predictions(spark, wh):
    features = spark.table(f"{wh.namespace}.features").limit(9)
    own = build(spark, features, fixture.predictions, fixture.registry(spark), "holdfast_derived")
    before = watchlist.watchlist_page(own).first()
    own.upsert_predictions(own.table("fact_prediction").withColumn("risk_score", 1 - F.col("risk_score")))
    after = watchlist.watchlist_page(own).first()
    lowest = own.watchlist_scores().agg(F.max("risk_score")).first()[0]
    assert after.risk_score == lowest and after.subscriber_id != before.subscriber_id
