"""Shards of near copies: trees over wide fingerprints, and large groups without a square of rows."""

import numpy as np
import pytest

from holdfast.llm import near_copies
from holdfast.llm.simhash import BKTree
from tests.llm.test_near_copies import brute_kept, edited


def near_texts(seed, n, low, high):
    """Texts with a number of words of one base changed: many pairs lie on either side of the bound."""
    rng = np.random.default_rng(seed)
    words = [f"w{x}" for x in rng.integers(0, 500, 200)]
    return [" ".join(edited(rng, words, int(rng.integers(low, high)))) for _ in range(n)]


def test_trees_find_all_pairs_within_the_radius():
    sets = [near_copies.shingles(t.encode().split()) for t in near_texts(1, 120, 1, 30)]
    prints = np.array([near_copies.fingerprint(s) for s in sets]).view(np.uint64)
    apart = np.bitwise_count(prints[:, None] ^ prints[None]).sum(axis=2)
    asked, found = BKTree(prints).search(prints, near_copies.RADIUS)
    assert set(zip(asked.tolist(), found.tolist())) == set(map(tuple, np.argwhere(apart <= near_copies.RADIUS).tolist()))
    for i, a in enumerate(sets):
        for j, b in enumerate(sets):
            both = len(np.intersect1d(a, b))
            assert 5 * both < 4 * (len(a) + len(b) - both) or apart[i, j] <= near_copies.RADIUS


def test_links_of_a_shard_join_the_same_groups_and_stay_below_its_nodes():
    sets = [near_copies.shingles(t.encode().split()) for t in near_texts(2, 150, 1, 9) + near_texts(3, 60, 1, 9)]

    def groups(pairs):
        label = list(range(len(sets)))
        for i, j in pairs:
            label = [min(label[i], label[j]) if x in (label[i], label[j]) else x for x in label]
        return label

    both = {(i, j): len(np.intersect1d(a, sets[j])) for i, a in enumerate(sets) for j in range(i)}
    similar = [(i, j) for (i, j), n in both.items() if 5 * n >= 4 * (len(sets[i]) + len(sets[j]) - n)]
    found = list(near_copies.shard_links(sets))
    assert groups(found) == groups(similar) and len(set(groups(found))) > 2
    assert len(found) < len(sets) < len(similar)


@pytest.mark.parametrize("block", [1 << 23, 1 << 15])  # one block, and many that meet in pairs
def test_large_shards_make_no_square_of_rows(spark, monkeypatch, block):
    texts = near_texts(5, 300, 6, 12)
    rows, made, verified = list(enumerate(texts)), [], near_copies._verified

    def counted(pairs, sets):
        made.append(pairs.count())
        return verified(pairs, sets)

    monkeypatch.setattr(near_copies, "_verified", counted)
    monkeypatch.setattr(near_copies, "BLOCK_BYTES", block, raising=False)
    got = near_copies.keep_one_per_group(spark.createDataFrame(rows, "doc_id long, text string").repartition(4))
    assert sorted(r.doc_id for r in got.collect()) == brute_kept(rows)
    assert sum(made) < 40 * len(rows)
