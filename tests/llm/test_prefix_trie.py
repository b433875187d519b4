"""The prefix trie against a plain one, and the defined results of odd input."""

import hashlib
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from holdfast.llm import prefix_trie as pt
from holdfast.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
COLUMNS = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"]


def rebuilt(rows):
    own = {}
    for conv, turn, role, text in rows:
        if conv is not None:
            own.setdefault(conv, []).append((turn is not None, turn or 0, role or "", text or ""))
    key = lambda t: (t[0], t[1], t[2], hashlib.md5(f"{len(t[2].encode())}:{t[2]}{t[3]}".encode()).digest())
    own = {c: [(r, t) for _, _, r, t in sorted(x, key=key)] for c, x in own.items()}
    out = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 4
        base = c - int(np.fmod(c, 20))
        out[c] = own.get(base, [])[:h] + turns[h:]
    return out


def brute(convs):
    members = {}
    for c, turns in convs.items():
        for d in range(len(turns) + 1):
            members.setdefault(tuple(turns[:d]), []).append(c)
    children = {p: 0 for p in members}
    for p in members:
        if p:
            children[p[:-1]] += 1
    leaves, saved = {p: 0 for p in members}, {p: 0 for p in members}
    for p, m in members.items():
        worth = (len(m) - 1) * len(re.findall(pt.WORD, p[-1][1])) if p else 0
        for d in range(len(p) + 1):
            leaves[p[:d]] += children[p] == 0
            saved[p[:d]] += worth
    out = []
    for p, m in members.items():
        ends = ",".join(str(c) for c in sorted(m) if len(convs[c]) == len(p))
        out.append((min(m), len(p), min(members[p[:-1]]) if p else None, len(m), children[p], leaves[p], saved[p], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=str)


def rows_of(df):
    assert df.columns == COLUMNS
    return sorted(map(tuple, df.collect()), key=str)


def frame(spark, rows):
    return spark.createDataFrame(rows, "conv_id long, turn long, role string, text string")


@pytest.mark.parametrize("folder", [SMALL, "/root/testdata/sf0.01"])
def test_query_against_brute_force(spark, folder):
    rows = spark.read.parquet(f"{folder}/conversations.parquet").select("conv_id", "turn", "role", "text").collect()
    assert rows_of(QUERIES["op12_prefix_trie"](spark, folder)) == brute(rebuilt(rows))


def test_odd_rows(spark):
    long = "ab " * 50000
    rows = [(0, None, None, None), (0, 1, "u", "a b"), (0, None, "u", "x"), (1, 0, "u", ""), (1, 0, "u", ""), (2, 5, None, long), (None, 1, "u", "lost"), (-21, 1, "u", "a b")]
    rows += [(c, t, "u", "same words") for c in range(3, 30) for t in range(4)] + [(40, 0, "u", "q"), (45, 0, "u", "only")]
    extra = frame(spark, rows).withColumns({c: F.lit("clash") for c in ("key", "block", "words", "path", "family", "id")})
    assert rows_of(pt.trie(pt.rebuilt(pt.turns_of(extra.repartition(3))))) == brute(rebuilt(rows))


def test_empty_table(spark):
    assert pt.trie(pt.rebuilt(pt.turns_of(frame(spark, [])))).collect() == []


def test_general_interface(spark):
    rows = [(7, 0, "u", "a"), (7, 1, "v", "b c"), (9, 0, "u", "a"), (8, 0, "v", "z")]
    convs = {7: [("u", "a"), ("v", "b c")], 9: [("u", "a")], 8: [("v", "z")]}
    assert rows_of(pt.trie(pt.conversations_of(pt.turns_of(frame(spark, rows))))) == brute(convs)


@pytest.mark.parametrize("seed, per_block", [(1, 1), (2, 2), (3, 3), (4, 7), (5, 1000)])
def test_blocks_recombine(spark, seed, per_block):
    """Blocks of any size give the same trie; many conversations are equal, or the beginning of others."""
    draw = random.Random(seed)
    convs = {c: [("u", draw.choice("ab") * draw.choice([1, 1, 2])) for _ in range(draw.choice([0, 1, 2, 3, 5, 8]))] for c in range(60)}
    convs |= {c: [("u", "x"), ("u", "y z")] for c in range(100, 130)}
    turns = pt.turns_of(frame(spark, [(c, i, r, t) for c, x in convs.items() for i, (r, t) in enumerate(x)]))
    some = pt.conversations_of(turns).unionByName(frame(spark, [(c, 0, "", "") for c, x in convs.items() if not x]).selectExpr("conv_id", "X'' AS path", "cast(array() AS array<int>) AS words"))

    def blocks(batches):
        for b in batches:
            for at in range(0, b.num_rows, per_block):
                yield from pt._nodes([b.slice(at, per_block)])

    real = pt._nodes
    pt_nodes, pt._nodes = blocks, blocks
    try:
        plan = pt.trie(some)
    finally:
        pt._nodes = real
    assert pt_nodes is blocks and rows_of(plan) == brute(convs)
