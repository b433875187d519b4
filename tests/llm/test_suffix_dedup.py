import hashlib
import random

import numpy as np
import pytest

from holdfast.llm import suffix_dedup as sd


def brute(texts, window):
    starts = {}
    data = [(t or "").encode() for t in texts]
    for n, t in enumerate(data):
        for i in range(len(t) - window + 1):
            starts.setdefault(t[i : i + window], []).append((n, i))
    gone = [bytearray(len(t)) for t in data]
    for places in starts.values():
        if len(places) > 1:
            for n, i in places:
                gone[n][i : i + window] = b"\1" * window
    out = []
    for t, g in zip(data, gone):
        runs = sum(1 for i, x in enumerate(g) if x and (i == 0 or not g[i - 1]))
        kept = bytes(c for c, x in zip(t, g) if not x)
        out.append((len(t), sum(g), runs, hashlib.sha256(kept).hexdigest()))
    return out


def corpus(seed, n, letters="abcé "):
    rng = random.Random(seed)
    word = lambda k: "".join(rng.choice(letters) for _ in range(k))
    shared = [word(rng.randint(10, 60)) for _ in range(5)]
    texts = []
    for _ in range(n):
        text = "".join(rng.choice([word(rng.randint(0, 25)), rng.choice(shared), rng.choice(shared)[3:-4]]) for _ in range(rng.randint(0, 6)))
        texts.append(text)
        if rng.random() < 0.2:
            texts.append(text)
        if rng.random() < 0.3 and len(text) > 8:
            at = rng.randrange(len(text))
            texts.append(text[:at] + "#" + text[at + 1 :])
    return texts + ["", None, "a" * 90, "ab" * 40, "é" * 30]


def report(spark, texts, **options):
    docs = spark.createDataFrame([(i, t, "x") for i, t in enumerate(texts)], "doc_id long, text string, th string").repartition(3)
    rows = sd.removal_report(docs, **options).orderBy("doc_id").collect()
    return [tuple(r)[1:] for r in rows]


@pytest.mark.parametrize("seed,window,group", [(1, 12, 20000), (2, 12, 2), (3, 20, 20000), (4, 16, 3)])
def test_matches_brute_force(spark, seed, window, group):
    texts = corpus(seed, 60)
    assert report(spark, texts, window=window, group=group) == brute(texts, window)


def test_few_letters(spark):
    texts = corpus(7, 50, letters="ab")
    assert report(spark, texts, window=12, group=4) == brute(texts, 12)


def test_production_window(spark):
    rng = random.Random(3)
    body = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    texts = [body, body[1000:1400], body[2000:2399], "x" + body[3000:3900] + "y" + body[3000:3900], None, "", body[:500] + "ü" + body[501:1200]]
    assert report(spark, texts) == brute(texts, 400)


def test_long_text_in_pieces(monkeypatch):
    monkeypatch.setattr(sd, "_PIECE", 64)
    import pyarrow as pa

    text = "".join(random.Random(1).choice("abcd") for _ in range(1000))

    def places():
        batch = pa.RecordBatch.from_arrays([pa.array([1]), pa.array([2]), pa.array([text])], names=["d", "t", "x"])
        return [p for b in sd._occurrences(20)([batch]) for p in b.column("pos").to_pylist()]

    pieces = places()
    monkeypatch.setattr(sd, "_PIECE", 1 << 20)
    assert pieces == places() and len(pieces) == len(set(pieces))


def test_repeated_rows_clashing_columns_and_kept_text(spark):
    t = "the same long passage of words again and again ü"
    rows = [(1, t, "s", 9), (1, t, "s", 9), (None, "zz" + t, None, None), (2, "other words altogether", "r", 22), (3, None, "r", None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, spans string, n_chars long")
    out = sd.remove_repeats(docs, window=20)
    assert out.columns == docs.columns
    got = sorted(map(tuple, out.collect()), key=str)
    want = [(1, "", "s", 0), (1, "", "s", 0), (None, "zz", None, 2), (2, "other words altogether", "r", 22), (3, None, "r", None)]
    assert got == sorted(want, key=str)
    assert sd.removal_report(docs.limit(0)).count() == 0


def test_least_between():
    values = np.random.default_rng(0).integers(0, 50, 37)
    least = sd._LeastBetween(values)
    a, b = np.array([(i, j) for i in range(37) for j in range(i, 37)]).T
    assert least(a, b).tolist() == [values[i : j + 1].min() for i, j in zip(a, b)]
