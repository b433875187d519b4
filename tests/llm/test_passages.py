import re

import numpy as np

import corpus_pipeline


def brute(texts):
    """The texts without the words of repeated runs of 51 words and without repeated strings of 400 bytes."""
    data = [t.encode() for t in texts]
    gone = [bytearray(len(t)) for t in data]
    places = {}
    for n, t in enumerate(data):
        at = [m.span() for m in re.finditer(rb"\S+", t)]
        words = t.split()
        for i in range(len(words) - 50):
            places.setdefault(tuple(words[i : i + 51]), []).append((n, at[i][0], at[i + 50][1]))
        for i in range(len(t) - 399):
            places.setdefault(t[i : i + 400], []).append((n, i, i + 400))
    for found in places.values():
        if len(found) > 1:
            for n, a, b in found:
                gone[n][a:b] = b"\1" * (b - a)
    return [bytes(c for c, g in zip(t, x) if not g).decode("utf-8", "ignore") for t, x in zip(data, gone)]


def test_passages_of_over_50_words_go_however_short_the_words(spark):
    rng = np.random.default_rng(2)
    words = lambda n, size: ["".join(rng.choice(list("abcdeä"), rng.integers(1, size + 1))) for _ in range(n)]
    texts = [words(int(rng.integers(0, 150)), 9) for _ in range(60)]
    for n in range(49, 63):  # planted in two texts each, 49 and 50 words are to stay
        passage = words(n, 4)
        for k in rng.choice(60, 2, replace=False):
            at = int(rng.integers(len(texts[k]) + 1))
            texts[k][at:at] = passage
    texts.append(["x"] * 60)
    rows = [(k, (" " if k % 3 else " \n ").join(t)) for k, t in enumerate(texts)]
    long = "".join(rng.choice(list("abc"), 420))  # one word
    rows += [(100, f"one {long} two"), (101, f"three {long} four")]
    got = corpus_pipeline.repeated_passages(spark, spark.createDataFrame(rows, "doc_id long, text string"), "").collect()
    want = brute([t for _, t in rows])
    assert [r.text for r in sorted(got)] == want
    assert sum(a != b for a, (_, b) in zip(want, rows)) > 10
