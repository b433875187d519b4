"""Merkle manifests against a plain tree, and the defined results of odd input."""

import hashlib
import zlib

import pytest
from pyspark.sql import functions as F

from holdfast.llm import merkle
from holdfast.llm.common import stored
from holdfast.llm.queries import QUERIES

SMALL = "/root/testdata/sf0.001"
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, plus=0):
    values = [row["doc_id"], row["source"], row["lang"], None if row["n_chars"] is None else row["n_chars"] + plus, row["text"]]
    return h("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values)


def tree(digests, arity=2):
    """The top, and of each leaf the siblings before and after it."""
    nodes, of, paths = list(digests), list(range(len(digests))), [[] for _ in digests]
    while len(nodes) > 1:
        runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
        for k, at in enumerate(of):
            run, place = runs[at // arity], at % arity
            paths[k].append(("".join(run[:place]), "".join(run[place + 1 :])))
        of = [at // arity for at in of]
        nodes = [h(r) for r in runs]
    return nodes[0], paths


def brute(rows):
    langs = sorted({r["lang"] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    kept, subroots = [], []
    for lang in langs:
        mine = sorted((r for r in rows if r["lang"] == lang), key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, leaf(r)))
        top, paths = tree([leaf(r) for r in mine])
        subroots.append(top)
        kept.append((mine, paths))
    root, above = tree(subroots)
    out = []
    for (mine, paths), sub, more in zip(kept, subroots, above):
        for r, path in zip(mine, paths):
            hit = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 7 == 0
            own = leaf(r, 1 if hit else 0)
            for before, after in path + more:
                own = h([before, own, after])
            out.append((r["doc_id"], leaf(r), sub, root, h(b + a for b, a in path + more), own, own == root))
    return sorted(out, key=str)


def rows_of(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_query_against_brute_force(spark):
    docs = [r.asDict() for r in spark.read.parquet(f"{SMALL}/documents.parquet").collect()]
    got = QUERIES["op13_merkle_manifest"](spark, SMALL)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    found = rows_of(got)
    assert found == brute(docs)
    assert 0 < sum(not r[-1] for r in found) < len(found) / 3


@pytest.mark.parametrize("arity, digits", [(2, 1), (2, 2), (3, 2), (4, 1)])
def test_other_shapes(spark, arity, digits):
    docs = [dict(doc_id=i, text=f"t{i}", lang=["en", "de", "x", None][min(i % 9, 3)], source="s", n_chars=i) for i in range(40)]
    leaves = merkle.leaves_of(spark.createDataFrame(docs, SCHEMA)).select("doc_id", "lang", "leaf")
    made = merkle.build(stored(leaves, "hashed"), arity=arity, digits=digits)
    found = {r.doc_id: r for r in merkle.prove(made, made.leaves).collect()}
    assert len(found) == 40
    langs = sorted({d["lang"] for d in docs}, key=lambda x: (x is not None, x or ""))
    tops = []
    for lang in langs:
        mine = [d for d in docs if d["lang"] == lang]
        top, paths = tree([leaf(d) for d in mine], arity)
        tops.append(top)
        for d, p in zip(mine, paths):
            assert found[d["doc_id"]].subroot == top
            assert [tuple(s) for s in found[d["doc_id"]].steps][: len(p)] == p
    assert made.root.first().digest == tree(tops, arity)[0]


def test_odd_rows(spark):
    same = dict(doc_id=4, text="again", lang="en", source="a", n_chars=5)
    docs = [
        dict(doc_id=None, text=None, lang=None, source=None, n_chars=None), dict(doc_id=None, text="", lang="en", source="", n_chars=0),
        same, same, same, dict(doc_id=7, text="é" * 70000, lang="", source="ß", n_chars=None), dict(doc_id=-3, text="x", lang="é", source=None, n_chars=1),
    ]
    frame = spark.createDataFrame(docs, SCHEMA).withColumns({c: F.lit("clash") for c in ("leaf", "tree", "rank", "n", "steps", "row")})
    assert rows_of(merkle.audit(frame.repartition(3))) == brute(docs)


def test_one_row_and_no_row(spark):
    one = [dict(doc_id=1, text="a", lang="en", source="s", n_chars=1)]
    assert rows_of(merkle.audit(spark.createDataFrame(one, SCHEMA))) == brute(one)
    assert merkle.audit(spark.createDataFrame([], SCHEMA)).collect() == []


def test_requests_by_rank(spark):
    docs = [dict(doc_id=i, text="t", lang="en", source="s", n_chars=1) for i in range(10)]
    made = merkle.build(stored(merkle.leaves_of(spark.createDataFrame(docs, SCHEMA)).select("doc_id", "lang", "leaf"), "hashed"))
    asked = spark.createDataFrame([(0, 3, "a", "x"), (0, 3, "b", "y"), (0, 10, "c", "z"), (5, 0, "d", "z")], "tree long, rank long, who string, subroot string")
    got = merkle.prove(made, asked).collect()
    assert sorted(r.who for r in got) == ["a", "b"] and got[0].steps == got[1].steps and len(got[0].steps) == 4


def test_a_tree_of_many_segments_is_numbered_in_order(spark):
    rows = spark.range(3000).selectExpr("(id * 7919) % 3000 AS doc_id", "if(id % 3 = 0, 'a', 'b') AS lang", "sha2(string(id), 256) AS leaf")
    made = merkle.build(stored(rows.repartition(7), "hashed"))
    for lang, number in (("a", 0), ("b", 1)):
        ranks = [r.rank for r in made.leaves.where(F.col("lang") == lang).orderBy("doc_id").collect()]
        assert ranks == list(range(len(ranks)))
        assert {r.tree for r in made.leaves.where(F.col("lang") == lang).select("tree").distinct().collect()} == {number}
    proofs = merkle.prove(made, made.leaves).select(merkle.folded(F.col("leaf"), F.col("steps")).alias("top")).distinct().collect()
    assert [r.top for r in proofs] == [made.root.first().digest]
