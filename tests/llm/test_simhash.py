import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from holdfast.llm import simhash
from holdfast.llm.components import connected_components


def brute_print(text):
    words = [w for w in (text or "").encode().lower().split()]
    grams = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_groups(values):
    label = list(range(len(values)))
    for _ in values:
        for i, a in enumerate(values):
            for j, b in enumerate(values):
                if bin(a ^ b).count("1") <= 2:
                    label[i] = label[j] = min(label[i], label[j])
    return label


def test_fingerprint_is_the_majority_of_spark_hashes(spark):
    texts = ["", "One", "a b  C d\x1cE f", "x y z x y z x y z", "Ähm ÄHM hm " * 9, None]
    for t in texts:
        assert simhash.fingerprint((t or "").encode()) == brute_print(t)
    h = spark.range(1).select(F.xxhash64(F.lit("one two three"))).first()[0] % 2**64
    assert h == xxhash.xxh64_intdigest(b"one two three", 42)


def test_tree_search_finds_every_value_within_the_radius():
    rng = np.random.default_rng(5)
    base = rng.integers(0, 2**63, 40, dtype=np.uint64)
    near = base ^ (np.uint64(1) << rng.integers(0, 64, 40).astype(np.uint64))
    values = np.unique(np.concatenate([base, near, near ^ np.uint64(5)]))
    q, v = simhash.BKTree(values).search(values, 2)
    got = set(zip(q.tolist(), v.tolist()))
    want = {(i, j) for i, a in enumerate(values) for j, b in enumerate(values) if bin(int(a) ^ int(b)).count("1") <= 2}
    assert got == want


@pytest.mark.parametrize("shard", [4096, 3])
def test_groups_match_brute_force(spark, monkeypatch, shard):
    monkeypatch.setattr(simhash, "SHARD", shard)
    rng = np.random.default_rng(1)
    chain = [0]
    for k in range(12):  # a chain of links of two bits each
        chain.append(chain[-1] ^ (3 << 2 * k))
    other = [int(x) for x in rng.integers(0, 2**63, 30)]
    values = sorted({*chain, *other, *(x ^ 9 for x in other[:9]), *(x ^ 1 for x in other[:9]), 2**63, 2**63 + 1})
    signed = [v - 2**64 if v >= 2**63 else v for v in values]
    edges = simhash.links(spark.createDataFrame([(s,) for s in signed], "fp long"))
    roots = dict(connected_components(edges).collect())
    mine = [roots.get(s, s) for s in signed]
    want = brute_groups(values)
    assert {tuple(i for i, m in enumerate(mine) if m == x) for x in set(mine)} == {
        tuple(i for i, m in enumerate(want) if m == x) for x in set(want)
    }


def test_odd_rows(spark):
    a = "the quick brown fox jumps over the lazy dog again and again"
    rows = [(3, a, "x"), (3, a, "x"), (7, a.upper(), None), (None, None, "y"), (5, "", "y"), (9, "\t \n", None), (None, "lone text here", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, fp string")
    got = sorted(map(tuple, simhash.near_duplicate_groups(docs).select("doc_id", "component_id").collect()), key=str)
    assert got == sorted([(3, 3), (3, 3), (7, 3), (None, 5), (5, 5), (9, 5), (None, None)], key=str)
    kept = simhash.keep_one_per_group(docs)
    assert kept.columns == docs.columns
    assert sorted(map(tuple, kept.collect()), key=str) == sorted([(3, a, "x"), (5, "", "y"), (None, "lone text here", None)], key=str)
    assert simhash.near_duplicate_groups(docs.limit(0)).count() == 0


def test_long_text():
    words = " ".join(str(i % 977) for i in range(70_000)).encode()
    assert simhash.fingerprint(words) == brute_print(words.decode())


def test_links_between_trees_of_one_shard(monkeypatch):
    monkeypatch.setattr(simhash, "SHARD", 3)
    rng = np.random.default_rng(2)
    values = np.unique(rng.integers(0, 2**9, 60, dtype=np.uint64))
    assert simhash._linked(values, 2).tolist() == brute_groups([int(v) for v in values])
