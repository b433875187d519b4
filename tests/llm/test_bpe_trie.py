import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow.parquet as pq
from tokenizers import Tokenizer

from holdfast.llm import bpe_trie

PATH = public_tokenizers.path("byte_bpe_50k.json")
LIBRARY = Tokenizer.from_file(PATH)
TEXTS = [
    "", None, "Hello world, it's we'll", "a  b   c \n d\n\n  e \t", " lead", "trail ", "  ", "\n \n", "a\n b", "a \nb", "x\xa0 y\x85z  ",
    "<|endoftext|>", "a <|endoftext|> b<|endoftext|><|endoftext|>  c", "日本語のテキスト 🙂🙂 ́", "12345 67,89", "aaaaaaaaaaaaaaaa" * 300,
    "supercalifragilistic supercalifragilist superc", "<|endoftext", "\x00\x1c\x7f", "ÀÉ éèê ß İ",
]


def same(texts):
    got = bpe_trie.TrieBPE(PATH).encode([t or "" for t in texts])
    for t, g in zip(texts, got):
        want = LIBRARY.encode(t or "", add_special_tokens=False).ids
        assert np.frombuffer(g, "<u4").tolist() == want, t
    return got


def test_encodes_as_the_library_does():
    rng = random.Random(2)
    letters = "aabcde thein,.!\n  '\té0189ñ日\xa0"
    got = same(TEXTS + ["".join(rng.choice(letters) for _ in range(150)) for _ in range(400)])
    bpe = bpe_trie.TrieBPE(PATH)
    for t, g in zip(TEXTS, got):
        assert bpe.decode(g) == LIBRARY.decode(np.frombuffer(g, "<u4").tolist(), skip_special_tokens=False) == (t or "")


def test_real_rows_with_little_memory(monkeypatch):
    monkeypatch.setattr(bpe_trie, "_KNOWN", 500)
    monkeypatch.setattr(bpe_trie, "_PAIRS", 1000)
    same(pq.read_table("/root/testdata/sf0.001/documents.parquet")["text"].to_pylist()[:60])


def test_report(spark):
    rows = [(i, t, "s") for i, t in enumerate(TEXTS)] + [(None, "no id", None), (3, TEXTS[3], "again")]
    docs = spark.createDataFrame(rows, "doc_id long, text string, n_tokens string")
    got = sorted((r.doc_id is None, r.doc_id, r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in bpe_trie.encoding_report(docs, PATH).collect())
    want = []
    for i, t, _ in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        decoded = LIBRARY.decode(ids, skip_special_tokens=False)
        want.append((i is None, i, len(ids), hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest(), hashlib.sha256(decoded.encode()).hexdigest()))
    assert got == sorted(want)
    assert bpe_trie.encoding_report(docs.limit(0), PATH).count() == 0
