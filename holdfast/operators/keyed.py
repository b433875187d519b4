"""Operators on a key: first row per key, upsert, and the choice of one registry row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from holdfast.sources.schema import CALIBRATED_MODELS, WATCHLIST_MODELS


def first_per_key(df: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """One row per key, chosen by a total order so that every run picks the same one: the given order, else the least row.

    The least row is an aggregate, so rows are sorted by the key alone and compared with each other only where keys are equal.
    With an order, Spark limits each map task to one row per key before the exchange (WindowGroupLimit). Either way a key
    with very many copies does not land whole in one task.
    """
    if order is None:
        others = [c for c in df.columns if c not in keys]
        if not others:
            return df.distinct()
        least = df.groupBy(*keys).agg(F.min(F.struct(*others)).alias("_least"))
        return least.select(*[F.col(c) if c in keys else F.col(f"_least.`{c}`") for c in df.columns])
    rank = F.row_number().over(W.partitionBy(*keys).orderBy(*order))
    return df.withColumn("_rank", rank).filter("_rank = 1").drop("_rank")


def upsert(old: DataFrame, new: DataFrame, keys: list[str], order: list[Column] | None = None) -> DataFrame:
    """Rows of ``new`` replace rows of ``old`` with the same key. Of several new rows per key the first in ``order``
    counts (order by a sequence, newest first, to keep the last); without an order they raise an error."""
    if order is None:
        # aggregates every column, so that one pass both counts the copies and carries the single row
        copies = F.when(F.count("*") > 1, F.raise_error(F.lit(f"several new rows per {', '.join(keys)}; give an order")))
        others = [c for c in new.columns if c not in keys]
        incoming = new.groupBy(*keys).agg(*[F.first(c).alias(c) for c in others], copies.cast("int").alias("_copies"))
        incoming = incoming.filter("_copies IS NULL").drop("_copies")
    else:
        incoming = first_per_key(new, keys, order)
    return old.join(incoming.select(*keys), keys, "left_anti").unionByName(incoming.select(*old.columns))


def preferred_run(registry: DataFrame) -> DataFrame:
    """The run the watchlist uses: best model by preference, then the newest. One row or none."""
    rank = F.lit(len(WATCHLIST_MODELS))
    for position, model in reversed(list(enumerate(WATCHLIST_MODELS))):
        rank = F.when(F.col("model_name") == model, position).otherwise(rank)
    return (
        registry.filter(F.col("model_name").isin(WATCHLIST_MODELS))
        .orderBy(rank, F.desc("trained_at"), "run_id")
        .limit(1)
        .select("run_id")
    )


def latest_calibrated_run(registry: DataFrame) -> DataFrame:
    """Newest calibrated run. One row or none."""
    return (
        registry.filter(F.col("model_name").isin(CALIBRATED_MODELS))
        .orderBy(F.desc("trained_at"), "run_id")
        .limit(1)
        .select("run_id")
    )


def of_run(predictions: DataFrame, run: DataFrame) -> DataFrame:
    """Predictions of the chosen run. The scalar subquery prunes the ``run_id`` partitions; without a run
    it is NULL and no row passes."""
    return predictions.filter(F.col("run_id") == run.scalar())
