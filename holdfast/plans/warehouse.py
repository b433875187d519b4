"""The star schema: five subscriber tables, predictions and the run registry.

The tables are written once, bucketed by ``subscriber_id`` into the session's shared folder, because
every report joins them on that key: bucketed scans join without an exchange, a key filter reads one
bucket, and a lost executor re-reads files instead of recomputing the pipeline. Predictions are also
partitioned by ``run_id``, so a report on one run reads only that run.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.operators.clean import clean
from holdfast.operators.features import add_features
from holdfast.operators.keyed import first_per_key, of_run, preferred_run, upsert
from holdfast.session import shared_dir
from holdfast.sources import fixture
from holdfast.sources.schema import PREDICTION_KEY, STAR

KEY = "subscriber_id"
_DERIVED: dict[str, dict[str, str]] = {}  # derived tables of each warehouse, by name
TABLES = [*STAR, "fact_prediction", "model_run"]


@dataclass(frozen=True)
class Warehouse:
    spark: SparkSession
    namespace: str

    def table(self, name: str) -> DataFrame:
        return self.spark.table(f"{self.namespace}.{name}")

    def star(self, *names: str) -> DataFrame:
        """Inner join of 1:1 star tables on the key.

        The five tables come from the same de-duplicated rows, so a report joins only those it reads.
        """
        return reduce(lambda a, b: a.join(b, KEY), [self.table(n) for n in names])

    def subscriber_360(self) -> DataFrame:
        """30-column flat table."""
        columns = [c for columns in STAR.values() for c in columns]
        return self.star(*STAR).select(KEY, *columns)

    def watchlist_scores(self) -> DataFrame:
        """Predictions of the preferred run. Each belongs to a subscriber (foreign key), so counting and
        ranking need no join."""
        return of_run(self.table("fact_prediction"), preferred_run(self.table("model_run")))

    def scored_watchlist(
        self, top: int | None = None, skip: int = 0, after: tuple[float, str] | None = None
    ) -> DataFrame:
        """Predictions of the preferred run with the profile columns of the call list.

        The whole list is left unordered. With ``top``, the highest scores are picked first and only those
        rows are joined to their profile. With ``after``, a score and an id, only rows ranked behind them count.
        """
        scores = self.watchlist_scores()
        if after is not None:
            score, key = after
            scores = scores.filter((F.col("risk_score") < score) | ((F.col("risk_score") == score) & (F.col(KEY) > key)))
        if top is not None:
            scores = scores.orderBy(F.desc("risk_score"), KEY).offset(skip).limit(top)
        return self.with_profile(scores)

    def with_profile(self, scores: DataFrame) -> DataFrame:
        """Predictions with the profile columns of the call list."""
        profile = self.star("dim_subscriber", "dim_contract", "fact_billing", "fact_attrition_label")
        return scores.join(profile, KEY).select(
            KEY, "model_name", "risk_score", "risk_band", "predicted_flag", "tenure_months", "tenure_band",
            "is_senior", "contract_type", "payment_method", "is_autopay", "monthly_charge", "churned_flag",
        )

    def derived(self, name: str, plan: Callable[[], DataFrame], partition_by: str) -> DataFrame:
        """A table computed from the stored ones and written on first use. New predictions or runs make it be computed
        anew; the earlier table stays, since plans that were made before may still read it."""
        known = _DERIVED.setdefault(self.namespace, {})
        if name not in known:
            table = f"{self.namespace}.{name}_{uuid.uuid4().hex[:8]}"
            plan().write.partitionBy(partition_by).saveAsTable(table)
            known[name] = table
        return self.spark.table(known[name])

    def changed(self) -> None:
        """Forget the derived tables, after predictions or the registry were written."""
        _DERIVED.pop(self.namespace, None)

    def n_buckets(self, name: str) -> int:
        """Buckets that a stored table was built with, whatever the session's shuffle width is now."""
        told = self.spark.sql(f"DESCRIBE EXTENDED {self.namespace}.{name}")
        return int(told.filter("col_name = 'Num Buckets'").first().data_type)

    def register_views(self) -> None:
        """Temp views over all tables and both report views, for ad-hoc SQL."""
        for name in TABLES:
            self.table(name).createOrReplaceTempView(name)
        self.subscriber_360().createOrReplaceTempView("vw_subscriber_360")
        self.scored_watchlist().createOrReplaceTempView("vw_scored_watchlist")

    def _own_session(self) -> SparkSession:
        """A session with the same catalog and its own views and settings."""
        own = self.spark.newSession()
        for setting in ("spark.sql.session.timeZone", "spark.sql.shuffle.partitions"):
            own.conf.set(setting, self.spark.conf.get(setting))
        return own

    def sql(self, text: str, args: dict | None = None) -> DataFrame:
        """SQL over the views, with bound parameters. The views are registered in a session of their own, so
        several warehouses can be used side by side."""
        own = Warehouse(self._own_session(), self.namespace)
        own.register_views()
        return own.spark.sql(text, args=args)

    def upsert_predictions(self, new: DataFrame, order: list[Column] | None = None) -> None:
        """Replace the stored predictions of the runs found in ``new``, row by row on the key. Of several new rows
        of one key the first in ``order`` counts; without an order such rows are an error.

        Only the touched ``run_id`` partitions are rewritten. The merged rows are staged as a table in the
        shared folder first, because a plan must not overwrite the files it reads.
        """
        stored = self.table("fact_prediction")
        touched = stored.join(new.select("run_id").distinct(), "run_id", "left_semi")
        stage = f"{self.namespace}.fact_prediction_stage"
        self.spark.sql(f"DROP TABLE IF EXISTS {stage}")
        merged = upsert(touched, new, PREDICTION_KEY, order)
        merged.write.mode("overwrite").saveAsTable(stage)
        # insertInto takes the overwrite mode from the session only, so the write has a session of its own
        own = self._own_session()
        own.conf.set("spark.sql.sources.partitionOverwriteMode", "dynamic")
        staged = own.table(stage).repartition(self.n_buckets("fact_prediction"), KEY).select(*stored.columns)
        staged.write.mode("overwrite").insertInto(f"{self.namespace}.fact_prediction")
        self.spark.catalog.refreshTable(f"{self.namespace}.fact_prediction")
        self.changed()
        self.spark.sql(f"DROP TABLE IF EXISTS {stage}")


def buckets(spark: SparkSession) -> int:
    """Bucket count: the shuffle width the cluster is sized for."""
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def build(
    spark: SparkSession, features: DataFrame, predictions, registry: DataFrame, namespace: str, n_buckets: int | None = None
) -> Warehouse:
    """Write all tables. ``predictions`` maps the stored feature table to prediction rows.

    ``n_buckets`` fixes the number of buckets of each table; size it so that one bucket of the widest table (about 300 bytes
    a subscriber) is some 200 MB. By default it is the shuffle width of the session.

    The feature rows are de-duplicated and stored once; the star tables are narrow copies of that table,
    so the upstream joins run once and not five times.
    """
    folder = f"{shared_dir(spark)}/{spark.sparkContext.applicationId}/{namespace}"
    spark.sql(f"CREATE DATABASE IF NOT EXISTS {namespace} LOCATION '{folder}'")

    def bucketed(df: DataFrame, name: str, partition_by: str | None = None) -> None:
        writer = df.write.mode("overwrite").format("parquet").bucketBy(n_buckets or buckets(spark), KEY).sortBy(KEY)
        if partition_by:
            writer = writer.partitionBy(partition_by)
        writer.saveAsTable(f"{namespace}.{name}")

    bucketed(first_per_key(features, [KEY]), "features")
    stored = spark.table(f"{namespace}.features")
    for name, columns in STAR.items():
        bucketed(stored.select(KEY, *columns), name)
    bucketed(predictions(stored), "fact_prediction", "run_id")
    registry.coalesce(1).write.mode("overwrite").format("parquet").saveAsTable(f"{namespace}.model_run")
    return Warehouse(spark, namespace)


_OPEN: dict[tuple[str, str], Warehouse] = {}


def open_warehouse(spark: SparkSession, sf_dir: str, rebuild: bool = False) -> Warehouse:
    """Warehouse over the test-data derivation, built on first use in this application."""
    application = spark.sparkContext.applicationId
    key = (application, sf_dir)
    if rebuild or key not in _OPEN:
        # every build has its own tables, so nothing that was derived from an earlier one can be mistaken for it
        namespace = "holdfast_" + hashlib.md5(f"{application}|{sf_dir}|{uuid.uuid4()}".encode()).hexdigest()[:12]
        features = add_features(clean(fixture.raw_subscribers(spark, sf_dir)))
        _OPEN[key] = build(spark, features, fixture.predictions, fixture.registry(spark), namespace)
    wh = _OPEN[key]
    return Warehouse(spark, wh.namespace)
