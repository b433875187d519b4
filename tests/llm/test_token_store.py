import random
import string
import unicodedata
import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from tokenizers import Tokenizer

from holdfast.llm import token_store as ts

PATH = public_tokenizers.path("word_bpe_49k.json")


@pytest.mark.parametrize("top", [2, 256, 257, 70_000, 2**32 - 1])
def test_codes_round_trip_and_random_access(top):
    ids = np.random.default_rng(top).integers(0, top, 3000, dtype=np.uint32)
    levels = ts.pack(ids)
    assert ts.unpack(levels).tolist() == ids.tolist()
    assert [ts.token_in(levels, i) for i in range(3000)] == ids.tolist()
    assert ts.pack(np.empty(0, np.uint32)) == [] and len(ts.unpack([])) == 0


TEXTS = [
    "Plain words, and MORE words.", "", None, "  \n\t x\x0by\x0cz\r ", "it's we'LL I'm DON'T x's,", "Élan ÑANDÚ, ΣΑΣ. Straße; İstanbul",
    "a\xa0b c d\x1ce\x85f", "é ́x 12,5 99. <|endoftext|> <|startoftext|>x a<|endoftext|>", "日本語 のテキスト。 🙂🙂!", "ends: in? marks!; ...", "word." * 3000,
]


def test_words_encode_as_the_library_does():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(3)
    letters = "abcdE FGé,.!?'s1 \n\x0b́ß"
    texts = TEXTS + ["".join(rng.choice(letters) for _ in range(200)) for _ in range(200)]
    got = ts.WordEncoder(PATH).encode([(t or "").encode().split() for t in texts])
    for t, g in zip(texts, got):
        assert g.tolist() == library.encode(t or "", add_special_tokens=False).ids, t


def test_memory_is_bounded(monkeypatch):
    monkeypatch.setattr(ts, "_CACHE", 3)
    e = ts.WordEncoder(PATH)
    a = [x.tolist() for x in e.encode([[b"one", b"two"], [b"three"]])]
    e.encode([[b"four", b"five"]])
    assert [x.tolist() for x in e.encode([[b"one", b"two"], [b"three"]])] == a and len(e.known) <= 3 and len(e.stems) <= 4


def test_store(spark, tmp_path):
    library = Tokenizer.from_file(PATH)
    ids = list(range(len(TEXTS)))
    random.Random(1).shuffle(ids)
    rows = [(i * 7 - 20, t, 1) for i, t in zip(ids, TEXTS)] + [(None, "no id", 2), (1, "one", 3), (1, "one", 3), (1, "two", 4)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, start long").repartition(4)
    store = ts.write_tokens(docs, str(tmp_path / "s"), PATH, 2)
    got = sorted(store.documents().collect(), key=lambda r: r.start)
    assert len(got) == len(rows)
    keys = [(r.doc_id is not None, r.doc_id or 0) for r in got]
    assert keys == sorted(keys)
    flat, at = [], 0
    coded = {}
    for i, t, _ in rows:
        coded.setdefault(i, []).append(library.encode(t or "", add_special_tokens=False).ids + [2])
    for r in got:
        match = [c for c in coded[r.doc_id] if zlib.crc32(np.array(c, "<u4").tobytes()) == r.ids_crc32]
        assert r.start == at and match and len(match[0]) == r.n_tokens
        flat += match[0]
        at += r.n_tokens
    for i in (0, 1, 17, at - 1):
        assert store.token(i) == flat[i]
    with pytest.raises(IndexError):
        store.token(at)
    empty = ts.write_tokens(docs.limit(0), str(tmp_path / "e"), PATH, 2)
    assert empty.documents().count() == 0


def test_every_cased_and_composed_letter_before_every_mark():
    """Letters that change in lower case or when composed, with each mark behind them, as the library encodes them."""
    changing = [c for c in map(chr, range(128, 0x1F000)) if c.isalpha() and (c.lower() != c or unicodedata.normalize("NFC", c) != c)]
    assert len(changing) > 1000 and "İ" in changing
    words = [f"BEN{c}{mark}" for c in changing for mark in (*".,!?;:", "")] + [f"x{c}e" for c in changing]
    got = ts.WordEncoder(PATH).encode([[w.encode()] for w in words])
    library = Tokenizer.from_file(PATH)
    want = library.encode_batch(words, add_special_tokens=False)
    assert [w for w, g, e in zip(words, got, want) if g.tolist() != e.ids] == []


def test_columns_encode_as_the_library_does():
    library = Tokenizer.from_file(PATH)
    rng = random.Random(5)
    letters = "abcdE FGé,.!?'s1 \n\x0b\x1c\x85\xa0́ßİΣ*#$<|>"
    texts = [t or "" for t in TEXTS] + ["".join(rng.choice(letters) for _ in range(200)) for _ in range(200)] + ["", "end "]
    got = ts.WordEncoder(PATH).encode_column(pa.array(["before", "it", *texts, "after"])[2:-1])
    assert [g.tolist() for g in got] == [library.encode(t, add_special_tokens=False).ids for t in texts]


def test_words_differ_from_their_stem_by_marks_alone():
    """The letters before any run of ASCII marks pass the library once, whatever marks follow."""
    marks = [a + b for a in string.punctuation for b in ("", *string.punctuation)] + ["***", ".&&&", "." * 300, "<|", "|>"]
    words = [stem + m for stem in ("Wort", "Ärgernis") for m in marks]
    e = ts.WordEncoder(PATH)
    got = e.encode([[w.encode()] for w in words])
    want = Tokenizer.from_file(PATH).encode_batch(words, add_special_tokens=False)
    assert [w for w, g, x in zip(words, got, want) if g.tolist() != x.ids] == []
    for stem in ("wort", "Ärgernis".encode().lower().decode()):
        assert [k for k in e.stems if k.startswith(stem.encode()) and b"'" not in k] == [stem.encode()]


def test_full_memory_keeps_the_words_at_hand(monkeypatch):
    monkeypatch.setattr(ts, "_CACHE", 4)
    e = ts.WordEncoder(PATH)
    e.encode([[b"one", b"two", b"three"]])
    asked = []
    library = e._library
    monkeypatch.setattr(e, "_library", lambda words: asked.extend(words) or library(words))
    e.encode([[b"one", b"four", b"five"]])
    assert sorted(asked) == [b"five", b"four"] and len(e.known) <= 4 and len(e.stems) <= 5


def test_every_letter_inside_a_word():
    """Words of letters alone skip the library's splitting, so Python and the library must agree on what a letter is."""
    words = [f"a{c}b" for c in map(chr, [*range(128, 0xD800), *range(0xE000, 0x110000)]) if ts._letters(c.encode())]
    got = ts.WordEncoder(PATH).encode_column(pa.array(words))
    want = Tokenizer.from_file(PATH).encode_batch_fast(words, add_special_tokens=False)
    assert len(words) > 100_000 and [w for w, g, e in zip(words, got, want) if g.tolist() != e.ids] == []
