"""Order MinHash against a plain version of the definition, and the defined results of odd input."""

import hashlib
import re
import struct

import pytest
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import order_minhash as om
from holdfast.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"


def signed(value):
    return value - (1 << 64) if value >> 63 else value


def hashed(parts, seed=42):
    for part in parts:
        if part is not None:
            seed = xxhash.xxh64_intdigest(part if isinstance(part, bytes) else part.encode(), seed)
    return seed


def brute_print(text):
    pieces = re.findall(om.PIECE, text or "")
    if not pieces:
        return "0000" * om.ENTRIES
    kmers = [pieces[i : i + om.SIZE] for i in range(len(pieces))]
    seen, ring = {}, []
    for at, kmer in enumerate(kmers):
        top = signed(hashed(kmer)) >> om.PLACE
        number = seen.get(top, 0)
        seen[top] = number + 1
        if number:
            top = signed(hashed([struct.pack("<q", top), struct.pack("<i", number)])) >> om.PLACE
        ring.append((top, at))
    ring.sort()
    out = []
    for entry in range(om.ENTRIES):
        start = (entry - om.ENTRIES // 2) << (om.BIN - om.PLACE)
        order = sorted(ring, key=lambda e: (e[0] < start, e))
        a, b = order[0][1], order[min(1, len(order) - 1)][1]
        first, last = min(a, b), max(a, b)
        out.append(f"{hashed([*kmers[first], '|', *kmers[last]]) & 65535:04x}")
    return "".join(out)


def alike(a, b):
    return sum(a[i : i + 4] == b[i : i + 4] for i in range(0, 4 * om.ENTRIES, 4)) / om.ENTRIES


def brute(rows):
    """Rows in order of descending id, ids equal or null in the order of their texts' hashes."""
    rows = [(i, t or "") for i, t in rows]
    rows = sorted(rows, key=lambda r: (r[0] is None, -(r[0] or 0), signed(hashed([r[1]]))))
    out = []
    for (ident, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        third = len(text) // 3
        edited = text[: len(text) - third] + after[:third]
        p, q, r = brute_print(text), brute_print(edited), brute_print(after)
        out.append((ident, len(text), hashlib.sha256(edited.encode()).hexdigest(), p, q, alike(p, q), alike(p, r)))
    return sorted(out, key=str)


def test_query_against_brute_force(spark):
    docs = spark.read.parquet(f"{SMALL}/documents.parquet").select("doc_id", "text").collect()
    got = QUERIES["op11_order_minhash"](spark, SMALL)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted(map(tuple, got.collect()), key=str) == brute([tuple(r) for r in docs])


@pytest.mark.parametrize("width", [2, 7])
def test_odd_rows(spark, width):
    long = "One two three. " * 3000 + "𝒳𝒴𝒵" * 400
    rows = [(5, None), (7, ""), (9, "  \n "), (None, "a b c"), (None, "d e f"), (3, "same text here"), (3, "same text here"), (3, "other text"), (-4, long), (8, "x"), (2**62, "Ünï cödé")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").withColumns({"order": F.lit(1), "print": F.lit("p"), "_slice": F.lit(2)})
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", width)
    try:
        got = sorted(map(tuple, om.edit_report(docs.repartition(3)).collect()), key=str)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert got == brute(rows)


def test_one_row_follows_itself_and_an_empty_table_gives_nothing(spark):
    one = om.edit_report(spark.createDataFrame([(1, "a b c d e f")], "doc_id long, text string")).collect()
    assert len(one) == 1 and one[0].near_next == 1.0
    assert om.edit_report(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_an_id_that_fills_slices_is_split(spark):
    rows = [(7, f"copy number {i}") for i in range(400)] + [(i, f"row {i}") for i in range(100)] + [(None, f"none {i}") for i in range(300)]
    got = sorted(map(tuple, om.edit_report(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute(rows)


def test_order_matters(spark):
    words = [f"w{i}" for i in range(400)]
    rows = [(1, " ".join(words)), (2, " ".join(words[200:] + words[:200])), (3, " ".join(words[:390]))]
    prints = om.with_fingerprint(spark.createDataFrame(rows, "id long, text string"), "text", "p").select("id", om.as_text("p").alias("p")).collect()
    p = {r.id: r.p for r in prints}
    assert alike(p[1], p[3]) > 0.85 and 0.2 < alike(p[1], p[2]) < 0.8


def test_no_python_workers(spark):
    plan = QUERIES["op11_order_minhash"](spark, SMALL)._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan
