"""Quality rules: base rules on words and lines, then a log-likelihood ratio of hashed n-grams.

Method: the bytes n-grams (2, 3 and 4 bytes) of every text are hashed to ``BINS`` bins. Two multinomials are counted over
the bins: the raw corpus (all rows) and the trusted target (rows whose labels say quality 1). A document's score is
the mean, over its n-grams, of log P(target) - log P(raw); it is kept from ``THRESHOLD`` on. The rule is fixed, so equal
texts always get equal verdicts. Bytes are used because words of a large corpus are mostly rare, and a rare word says
nothing in a word model.

The raw corpus is all rows, counted with partial sums per task; the model is ``BINS`` numbers whatever the corpus. The target
is fitted on at most ``TRUSTED`` labelled rows, chosen by the hash of their ids; this bounds the ids that are broadcast, so
texts are never shuffled.

Defined results: null text has no words and fails the base rules; so does an empty text, whose score is 0. Ids that occur
several times in labels are trusted if all their labels agree on 1. Without trusted rows every score is 0. Rows repeat as
they come; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import as_bytes, lean, tidy, windows_of_three, word_ids

BINS = 1 << 16
SIZES = (2, 3, 4)
THRESHOLD = -0.4  # nats per n-gram
TRUSTED = 100_000  # labelled rows at most from which the target is counted
_BLOCK = 1 << 20
_SYMBOLS = np.isin(np.arange(256), np.frombuffer(b"#*$%&|<>", np.uint8))
_SPACE = np.isin(np.arange(256), np.frombuffer(b" \t\n\r\v\f", np.uint8))


def gram_bins(text: bytes) -> Iterator[np.ndarray]:
    """Bins of all n-grams of a text, a block of the text and an n-gram size at a time."""
    for lo in range(0, len(text), _BLOCK):
        part = np.frombuffer(text[lo : lo + _BLOCK + max(SIZES) - 1], np.uint8).astype(np.uint32)
        for n in SIZES:
            ends = min(_BLOCK, len(part) - n + 1)
            if ends < 1:
                continue
            h = np.zeros(ends, np.uint32)
            for k in range(n):
                h = (h + part[k : k + ends] + np.uint32(1)) * np.uint32(0x9E3779B1)
                h ^= h >> np.uint32(15)
            yield h & np.uint32(BINS - 1)


def trusted_ids(labels: DataFrame, most: int = TRUSTED) -> np.ndarray:
    """Ids whose labels all say quality 1, sorted; of more than ``most``, those whose hashes are lowest."""
    agreed = labels.groupBy("doc_id").agg(F.min("quality").alias("q"), F.max("quality").alias("p")).where("q = 1 and p = 1 and doc_id is not null")
    chosen = agreed.select(F.col("doc_id").cast("long").alias("id")).orderBy(F.xxhash64("id"), "id").limit(most)
    return np.sort(np.array([r.id for r in chosen.collect()], np.int64))


def fit(docs: DataFrame, labels: DataFrame, most: int = TRUSTED) -> np.ndarray:
    """Log ratio of target and raw probability per bin, with one count added to each bin."""
    trusted = docs.sparkSession.sparkContext.broadcast(trusted_ids(labels, most))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        raw, target = np.zeros(BINS, np.int64), np.zeros(BINS, np.int64)
        for batch in batches:
            known = batch.column(0).is_valid().to_numpy(zero_copy_only=False)
            known &= np.isin(batch.column(0).fill_null(0).to_numpy(), trusted.value)
            for text, counts_twice in zip(as_bytes(batch.column(1)), known.tolist()):
                for bins in gram_bins(text):
                    counts = np.bincount(bins, minlength=BINS) if len(bins) > 5000 else None
                    for total in (raw, target) if counts_twice else (raw,):
                        if counts is not None:
                            total += counts
                        else:
                            np.add.at(total, bins, 1)
        used = np.flatnonzero(raw)
        yield pa.RecordBatch.from_arrays(
            [pa.array(used, pa.int32()), pa.array(raw[used]), pa.array(target[used])], names=["bin", "raw", "target"]
        )

    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    counted = texts.mapInArrow(lean(count), "bin int, raw long, target long").groupBy("bin").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    raw, target = np.zeros(BINS), np.zeros(BINS)
    for row in counted.collect():  # BINS rows at most
        raw[row.bin], target[row.bin] = row.raw, row.target
    if not target.any():
        return np.zeros(BINS)
    return np.log((target + 1) / (target.sum() + BINS)) - np.log((raw + 1) / (raw.sum() + BINS))


def score(text: bytes, weights: np.ndarray) -> float:
    total, n = 0.0, 0
    for bins in gram_bins(text):
        total += float(weights[bins].sum())
        n += len(bins)
    return total / n if n else 0.0


def measures(text: bytes) -> tuple[int, int, int, int, int]:
    """(n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words)."""
    data = np.frombuffer(text, np.uint8)
    chars = int(np.count_nonzero((data & 0xC0) != 0x80) - np.count_nonzero(_SPACE[data]))
    seen: set[bytes] = set()
    repeated_lines = 0
    for line in text.split(b"\n"):
        if line in seen:
            repeated_lines += bool(line.strip())  # on bytes this knows ASCII white space only
        else:
            seen.add(line)
    words = text.split()
    ids, distinct = word_ids(words)
    repeated = 0
    if len(words) > 2:
        _, which, times = np.unique(windows_of_three(ids, distinct), return_inverse=True, return_counts=True)
        again = times[which] > 1
        inside = np.zeros(len(words), dtype=bool)
        for k in range(3):
            inside[k : k + len(again)] |= again
        repeated = int(inside.sum())
    return len(words), chars, int(np.count_nonzero(_SYMBOLS[data])), repeated_lines, repeated


def base_failed(n_words: int, n_repeat_words: int) -> bool:
    return n_words < 50 or 100 * n_repeat_words > 50 * n_words


_REPORT = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")]
    + [("base_failed", pa.bool_()), ("kept", pa.bool_()), ("llr", pa.float64())]
)
_REPORT_DDL = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "base_failed boolean, kept boolean, llr double"
)


def quality_report(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """One row per row of ``docs``: the measures, ``base_failed``, ``kept`` and the score ``llr``."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    def judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[list] = [[] for _ in range(8)]
            for text in as_bytes(batch.column(1)):
                got = measures(text)
                failed = base_failed(got[0], got[4])
                ratio = score(text, model.value)
                for column, x in zip(found, (*got, failed, not failed and ratio >= threshold, ratio)):
                    column.append(x)
            columns = [batch.column(0), *(pa.array(c, f.type) for c, f in zip(found, list(_REPORT)[1:]))]
            yield pa.RecordBatch.from_arrays(columns, schema=_REPORT)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(judge, _REPORT_DDL)


def keep_good(docs: DataFrame, labels: DataFrame, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that ``quality_report`` keeps."""
    model = docs.sparkSession.sparkContext.broadcast(fit(docs, labels))

    @F.arrow_udf(T.BooleanType())
    def kept(text: pa.Array) -> pa.Array:
        tidy()
        out = []
        for t in as_bytes(text):
            got = measures(t)
            out.append(not base_failed(got[0], got[4]) and score(t, model.value) >= threshold)
        return pa.array(out, pa.bool_())

    return docs.where(kept(F.col("text").cast("string")))
