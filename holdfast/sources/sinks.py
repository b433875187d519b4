"""Sinks: CSV, JSON, table exports and the call-list bundle. Every write is a distributed write."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_csv(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).option("header", True).csv(path)


def write_json(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    df.write.mode(mode).json(path)


def append(df: DataFrame, path: str) -> None:
    df.write.mode("append").parquet(path)


def as_records(df: DataFrame, name: str = "records") -> DataFrame:
    """One row holding a report as a list of records. For report tables of bounded size only."""
    return df.agg(F.collect_list(F.struct(*df.columns)).alias(name))


def export_tables(tables: dict[str, DataFrame], folder: str) -> None:
    """One CSV dataset per table."""
    for name, df in tables.items():
        write_csv(df, f"{folder}/{name}")


def export_call_list(subscriber_360: DataFrame, ranked_watchlist: DataFrame, folder: str, top: int = 500) -> None:
    """The full subscriber table and the ``top`` rows of the ranked watchlist, in one bundle folder."""
    write_csv(subscriber_360, f"{folder}/subscribers")
    write_csv(
        ranked_watchlist.orderBy(F.desc("risk_score"), "subscriber_id").limit(top), f"{folder}/retention_call_list"
    )
