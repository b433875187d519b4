"""Helpers shared by the operators: reading tables, rows as Arrow batches, and tables written to the shared folder."""

from __future__ import annotations

import ctypes
import gc
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from holdfast.session import shared_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once below the session's shared folder and read it back: later steps depend on the files
    only, not on the executors that computed them."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bound_batches(spark: SparkSession, megabytes: int = 4) -> None:
    """From now on Arrow batches of the session hold at most so many MB: 10,000 whole texts, the other bound, may be any size."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    spark.conf.set(name, f"{megabytes}m")


#: What operators keep in a worker from task to task, by operator.
HELD: dict[str, dict] = {}


def tidy(keep: str = "") -> None:
    """Give memory back to the system: what operators other than ``keep`` hold in this worker, and what Arrow and the C library
    have freed but not returned. Workers serve the tasks of all operators, one after the other."""
    for store in [s for name, s in HELD.items() if name != keep and s]:
        store.clear()
        gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # glibc only
    if trim is not None:
        trim(0)


def lean(work: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], keep: str = "") -> Callable:
    """``work`` over a task's batches, in a worker that is tidied before and after."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tidy(keep)
        yield from work(batches)
        tidy(keep)

    return run


def as_bytes(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a text column; null counts as the empty text."""
    return [b"" if x is None else x for x in column.cast(pa.binary()).to_pylist()]


def word_ids(words: list[bytes]) -> tuple[np.ndarray, int]:
    """Number equal words alike, in order of first appearance: the numbers and how many words differ."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    return ids, len(seen)


def windows_of_three(ids: np.ndarray, distinct: int) -> np.ndarray:
    """One number per window of three words, equal exactly when the windows are equal."""
    if len(ids) < 3:
        return np.empty(0, dtype=np.int64)
    if distinct < 2_000_000:
        return (ids[:-2] * distinct + ids[1:-1]) * distinct + ids[2:]
    pairs = np.unique(ids[:-1] * distinct + ids[1:], return_inverse=True)[1]  # keeps the product below 2^63
    return pairs[:-1] * distinct + ids[2:]


def by_crc(doc_id: str) -> F.Column:
    """Remainder of crc32(doc_id as text) by 4, which fixes the held-out rows."""
    return F.crc32(F.col(doc_id).cast("string")) % 4
