import random
import re
from collections import Counter

import numpy as np

from holdfast.llm import quality_rules as qr

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def brute(text):
    text = text or ""
    words = WORD.findall(text)
    lines = text.split("\n")
    dup = sum(1 for i, x in enumerate(lines) if WORD.search(x) and x in lines[:i])
    times = Counter(zip(words, words[1:], words[2:]))
    inside = set()
    for i, w in enumerate(zip(words, words[1:], words[2:])):
        if times[w] > 1:
            inside |= {i, i + 1, i + 2}
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(inside)


TEXTS = [
    "", " \n\t", "one", "a b", "a a a a", "x y z\nx y z\n\n\nx y z\n \n ", "é|ü #*$%&<> ü x  y\x1cz",
    "tab\there\x0bvt\x0cff\rcr", "a b c d a b c e a b", "\n".join(["same line"] * 5) + "\nother",
]


def test_measures_match_brute_force():
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abcd") for _ in range(rng.randint(0, 40))) for _ in range(50)]
    for t in texts:
        assert qr.measures(t.encode()) == brute(t), t


def test_blocks_do_not_change_the_n_grams(monkeypatch):
    text = "".join(random.Random(2).choice("abcdeé ") for _ in range(500)).encode()
    whole = sorted(np.concatenate(list(qr.gram_bins(text))).tolist())
    monkeypatch.setattr(qr, "_BLOCK", 7)
    assert sorted(np.concatenate(list(qr.gram_bins(text))).tolist()) == whole
    assert len(whole) == sum(len(text) - n + 1 for n in qr.SIZES)


def test_report_and_verdict(spark):
    rng = random.Random(1)
    good = lambda: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(rng.randint(2, 8))) for _ in range(80))
    junk = lambda: " ".join("".join(rng.choice("aeioulmnrst") for _ in range(4)) + "$$$%%%" for _ in range(80))
    rows = [(i, good(), "x") for i in range(40)] + [(100 + i, junk(), None) for i in range(20)]
    rows += [(200, None, None), (201, "", None), (None, good(), None), (5, rows[5][1], "again"), (202, "same words here " * 40, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, trusted string").repartition(3)
    labels = spark.createDataFrame([(i, 1) for i in range(25)] + [(100 + i, 0) for i in range(5)] + [(7, 0), (None, 1), (9, None)], "doc_id long, quality int")
    got = qr.quality_report(docs, labels).collect()
    assert len(got) == len(rows)
    by = {r.doc_id: r for r in got}
    want = {i: brute(t) for i, t, _ in rows}
    for i, r in by.items():
        assert tuple(r)[1:6] == want[i]
        assert r.base_failed == (r.n_words < 50 or 100 * r.n_repeat_words > 50 * r.n_words)
    assert all(by[i].kept for i in range(40)) and by[None].kept
    assert not any(by[i].kept for i in [*range(100, 120), 200, 201, 202])
    raw, target, trusted = np.zeros(qr.BINS), np.zeros(qr.BINS), set(range(25)) - {7}
    for i, t, _ in rows:
        for bins in qr.gram_bins((t or "").encode()):
            np.add.at(raw, bins, 1)
            if i in trusted:
                np.add.at(target, bins, 1)
    ratio = np.log((target + 1) / (target.sum() + qr.BINS)) - np.log((raw + 1) / (raw.sum() + qr.BINS))
    assert np.allclose(qr.fit(docs, labels), ratio)
    kept = qr.keep_good(docs, labels)
    assert kept.columns == docs.columns and kept.count() == 42
    assert qr.quality_report(docs.limit(0), labels.limit(0)).count() == 0
