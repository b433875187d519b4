import random
from collections import Counter

import numpy as np

from holdfast.llm import decontamination as dc


def gram_counts(words):
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)))


def brute(text, items):
    words, out = dc.words_of(text), []
    for i, t in items:
        w = dc.words_of(t)
        if not w:
            continue
        mine, best = gram_counts(w), (0.0, 0)
        if len(w) < 5:
            places = [k for k in range(len(words) - len(w) + 1) if words[k : k + len(w)] == w]
            best = (1.0, places[0]) if places else best
        else:
            for k in range(max(1, len(words) - len(w) + 1) if len(words) >= 5 else 0):
                there = gram_counts(words[k : k + len(w)])
                common = sum((there & mine).values())
                alike = common / sum((there | mine).values())
                if alike >= 0.8 and alike > best[0]:
                    best = (alike, k)
        if best[0]:
            out.append((i, best[1], round(best[0], 9)))
    return sorted(out)


def make(seed, n_items=12, n_docs=80):
    rng = random.Random(seed)
    vocabulary = ["".join(rng.choice("abcdefgé") for _ in range(rng.randint(1, 6))) for _ in range(300)]
    text = lambda n: [rng.choice(vocabulary) for _ in range(n)]
    items = [(i, " ".join(text(rng.randint(12, 60)))) for i in range(n_items)]
    items += [(90, None), (91, "..."), (92, "three rare words"), (93, "a b a b a b a b a b a b a b a b")]
    docs = []
    for d in range(n_docs):
        words = text(rng.randint(0, 120))
        if d % 2:
            planted = dc.words_of(rng.choice(items)[1])
            for _ in range(rng.choice([0, 0, 1, 2])):
                if planted:
                    planted[rng.randrange(len(planted))] = "changed"
            at = rng.randint(0, len(words))
            words[at:at] = planted
        docs.append((d, ", ".join(words).title()))
    return items, docs


def test_windows_match_brute_force():
    for seed in range(4):
        items, docs = make(seed)
        block = dc.Items(items)
        for _, text in docs:
            got = sorted((i, s, round(a, 9)) for i, s, a in block.leaks(text))
            assert got == brute(text, items)


def test_index_finds_everything_within_the_radius():
    rng = np.random.default_rng(3)
    values = rng.integers(0, 2**63, 60, dtype=np.uint64)
    index = dc.MultiIndex([int(v) for v in values], 20)
    for _ in range(200):
        q = int(values[rng.integers(60)])
        for bit in rng.choice(64, rng.integers(0, 26), replace=False):
            q ^= 1 << int(bit)
        want = [k for k, v in enumerate(values) if bin(int(v) ^ q).count("1") <= 20]
        places, found = index.search(np.array([q, int(values[0])], np.uint64))
        assert found[places == 0].tolist() == want and 0 in found[places == 1]


def test_lookups_in_parts_find_the_same(monkeypatch):
    rng = np.random.default_rng(4)
    values = rng.integers(0, 2**20, 50, dtype=np.uint64)
    queries = rng.integers(0, 2**20, 300, dtype=np.uint64)
    index = dc.MultiIndex([int(v) for v in values], 6)
    whole = [x.tolist() for x in index.search(queries)]
    monkeypatch.setattr(dc, "_PAIRS", 120)
    assert [x.tolist() for x in index.search(queries)] == whole and len(whole[0]) > 50
    assert [x.tolist() for x in index.search(queries[:0])] == [[], []]


def test_documents_shorter_than_the_item():
    words = [f"w{k}" for k in range(30)]
    block = dc.Items([(1, " ".join(words)), (2, "one two three")])
    assert [(i, s, round(a, 3)) for i, s, a in block.leaks(" ".join(words[:28]))] == [(1, 0, round(24 / 26, 3))]
    assert [i for i, _, _ in block.leaks(" ".join(words[3:29]))] == [1]
    assert block.leaks(" ".join(words[:24])) == []  # 20 of 26 shingles
    assert [(i, s) for i, s, _ in block.leaks("zero one two three")] == [(2, 1)]
    assert [(i, s) for i, s, _ in block.leaks("one two three")] == [(2, 0)]
    assert block.leaks("one two") == [] == block.leaks("w0")


def test_long_text_and_rounds(monkeypatch):
    items, docs = make(9)
    text = " . ".join(t for _, t in docs)
    whole = dc.Items(items).leaks(text)
    monkeypatch.setattr(dc, "_ROUND", 3)
    assert dc.Items(items).leaks(text) == whole and whole


def test_tables(spark, monkeypatch):
    items, docs = make(5)
    rows = [(d, t, "x") for d, t in docs] + [(None, docs[1][1], None), (3, docs[3][1], "again"), (200, None, None), (201, "", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, item_id string").repartition(3)
    bench = spark.createDataFrame([*items, (items[0][0], items[0][1])], "item_id long, text string")
    want = sorted([(str(d), i, s) for d, t, _ in rows for i, s, _ in brute(t, items)])
    single = spark.createDataFrame(items, "item_id long, text string")
    got = sorted((str(r.doc_id), r.item_id, r.first_word) for r in dc.find_leaks(table, single).collect())
    assert got == want
    monkeypatch.setattr(dc, "BLOCK_CHARS", 300)
    assert len(dc.item_blocks(single)) > 3
    assert sorted((str(r.doc_id), r.item_id, r.first_word) for r in dc.find_leaks(table, single).collect()) == want
    leaking = {d for d, _, _ in want}
    kept = dc.without_leaks(table, bench)
    assert kept.columns == table.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(str(d) for d, _, _ in rows if str(d) not in leaking)
    assert dc.find_leaks(table, single.limit(0)).count() == 0 == dc.find_leaks(table.limit(0), single).count()
