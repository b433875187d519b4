"""Removal of passages of over 50 words that repeat, besides byte strings of the window of ``suffix_dedup``.

Every word that a run of ``WORDS`` words covers is removed if the same run also starts anywhere else, however few bytes it has. Words
become codes of ``CODE`` bytes each, so that such a run is a string of ``WORDS * CODE`` bytes, and the induced sorting of ``suffix_dedup``
finds the repeated ones; their places are read back as words of the text. Strings of 400 bytes go as before, also those of few long words.
Both are judged on the texts as they come in.

Defined results: words are split at ASCII whitespace and compared as they are, whatever whitespace lies between them. Whitespace around
a passage stays. Runs are equal up to equality of their words' 32-bit hashes, all of them.
"""

from __future__ import annotations

import re

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import as_bytes, stored
from holdfast.llm.suffix_dedup import GROUP, WINDOW, kept_parts, repeated_spans

WORDS = 51
CODE = 4  # bytes of a word's code
_WORD = re.compile(rb"\S+")


@F.arrow_udf(T.BinaryType())
def _codes(text: pa.Array) -> pa.Array:
    out = []
    for t in as_bytes(text):
        words = t.split()
        out.append(np.fromiter(map(xxhash.xxh32_intdigest, words), dtype="<u4", count=len(words)).tobytes())
    return pa.array(out, pa.binary())


def in_bytes(text: bytes, spans: list | None) -> list[dict]:
    """Spans over the codes of a text as spans over the text."""
    if not spans:
        return []
    at = [m.span() for m in _WORD.finditer(text)]
    found = ((-(-s["start"] // CODE), s["end"] // CODE) for s in spans)
    return [{"start": at[a][0], "end": at[b - 1][1]} for a, b in found if b > a]


@F.arrow_udf(T.StringType())
def _kept_text(text: pa.Array, spans: pa.Array, words: pa.Array) -> pa.Array:
    """A character of which a part goes goes as a whole."""
    rows = zip(as_bytes(text), spans.to_pylist(), words.to_pylist())
    return pa.array([b"".join(kept_parts(t, [*(s or ()), *in_bytes(t, w)])[0]).decode("utf-8", "ignore") for t, s, w in rows], pa.string())


def _all_spans(named: DataFrame, group: int) -> DataFrame:
    """(doc_id, th, spans, words) of the texts with repeats: spans over bytes and over codes."""
    by_bytes = stored(repeated_spans(named, WINDOW, group), "spans")
    coded = stored(named.withColumn("text", _codes("text")), "codes")  # read twice, and never in a task with a second Python worker
    by_words = stored(repeated_spans(coded, WORDS * CODE, group), "spans")
    none = F.expr("CAST(NULL AS array<struct<start:int,end:int>>)")
    both = by_bytes.withColumn("words", none).unionByName(by_words.withColumnRenamed("spans", "words").withColumn("spans", none))
    return both.groupBy("doc_id", "th").agg(F.first("spans", True).alias("spans"), F.first("words", True).alias("words"))


def remove_passages(docs: DataFrame, group: int = GROUP) -> DataFrame:
    """All rows and columns of ``docs``; texts with repeats are cut (characters cut in half go), other texts stay as they
    are (null too). Where there is a column n_chars it counts the characters that are left."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    named = docs.select(F.struct("*").alias("row")).select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"))
    spans = _all_spans(named.select("doc_id", "th", text.alias("text")), group)
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th"))
    found = named.alias("d").join(spans.alias("s"), same, "left").select("d.row", "s.spans", "s.words", F.col("s.th").isNotNull().alias("changed"))
    cut = F.when(F.col("changed"), _kept_text(F.col("row.text"), F.col("spans"), F.col("words"))).otherwise(F.col("row.text"))
    ready = found.select("row", cut.alias("cut"), "changed")
    columns = []
    for name, kind in docs.dtypes:
        mine = F.col(f"row.`{name}`")
        if name == "text":
            mine = F.col("cut")
        elif name == "n_chars":
            mine = F.when(F.col("changed"), F.char_length("cut").cast(kind)).otherwise(mine)
        columns.append(mine.alias(name))
    return ready.select(*columns)
