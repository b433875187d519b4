import numpy as np
import pytest

import corpus_pipeline
from holdfast.llm import near_copies


def brute_set(text):
    words = (text or "").encode().lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4))}


def brute_kept(rows):
    """Smallest id of each group of chains of pairs with similarity >= 0.8."""
    sets, label = [brute_set(t) for _, t in rows], list(range(len(rows)))

    def top(i):
        while label[i] != i:
            i = label[i]
        return i

    for i, a in enumerate(sets):
        for j in range(i):
            if 5 * len(a & sets[j]) >= 4 * len(a | sets[j]) and top(i) != top(j):
                label[top(i)] = top(j)
    least = {}
    for i, (doc, _) in enumerate(rows):
        least[top(i)] = min(least.get(top(i), doc), doc)
    return sorted(least.values())


def edited(rng, words, n):
    out = list(words)
    for at in rng.choice(len(out), n, replace=False):
        out[at] = f"new{rng.integers(1 << 40)}"
    return out


@pytest.mark.parametrize("small", [32, 3])  # with 3, every group of copies goes by pivots
def test_same_groups_as_all_pairs(spark, monkeypatch, small):
    rng = np.random.default_rng(3)
    rows = []
    for base in range(30):
        words = [f"w{x}" for x in rng.integers(0, 500, int(rng.integers(60, 300)))]
        rows.append((len(rows), " ".join(words)))
        for n in (1, 2, 3, 4, 5, 6, 8):  # from near copies to texts just below the bound
            rows.append((len(rows), " ".join(edited(rng, words, n))))
        if base == 0:
            for _ in range(60):
                rows.append((len(rows), " ".join(edited(rng, words, int(rng.integers(1, 7))))))
    rows += [(len(rows) + k, t) for k, t in enumerate(["", "  ", "One two", "one TWO", "one three"])]
    order = rng.permutation(len(rows))
    monkeypatch.setattr(near_copies, "SMALL", small)
    docs = spark.createDataFrame([rows[k] for k in order], "doc_id long, text string")
    got = sorted(r.doc_id for r in corpus_pipeline.near_duplicates(spark, docs, "").collect())
    assert got == brute_kept(rows)


def test_pivots_leave_every_pair_that_they_do_not_settle():
    rng = np.random.default_rng(9)
    sets = [set(range(100))]
    for _ in range(80):
        sets.append(set(rng.choice(140, int(rng.integers(80, 120)), replace=False)) if rng.random() < 0.3 else sets[rng.integers(len(sets))] ^ set(rng.integers(0, 140, 8)))
    inter = np.array([[len(a & p) for p in sets[:4]] for a in sets])
    total = np.array([[len(a | p) for p in sets[:4]] for a in sets])
    left = {(int(a), int(b)) for x, y in near_copies.left_open(np.arange(len(sets)), inter, total) for a, b in zip(x, y)}
    pairs = [(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets))]
    similar = {(i, j) for i, j in pairs if 5 * len(sets[i] & sets[j]) >= 4 * len(sets[i] | sets[j])}
    label = list(range(len(sets)))
    for i, j in sorted(similar & (left | {(i, j) for i, j in pairs if i < 4})):
        a, b = label[i], label[j]
        label = [min(a, b) if x in (a, b) else x for x in label]
    assert all(label[i] == label[j] for i, j in similar)


def test_odd_rows(spark):
    """Nulls, repeated rows, clashing names and a map beside the texts; an empty table."""
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(3, text), (3, text), (None, text), (None, "alone here"), (None, "alone here"), (7, None), (5, ""), (9, "b " * 30000), (2**40, "B " * 30000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "map('a', doc_id) AS extra", "1 AS row", "2 AS node", "3 AS id", "4 AS rank")
    got = near_copies.keep_one_per_group(docs.repartition(4))
    assert got.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in got.collect()), key=str) == sorted([(3, text), (None, "alone here"), (5, ""), (9, "b " * 30000)], key=str)
    assert near_copies.keep_one_per_group(docs.limit(0)).collect() == []
