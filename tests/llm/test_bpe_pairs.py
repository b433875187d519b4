"""Pairs of tokens: the stable ones are those that plain merging gives again, and a worker remembers many."""

import random

from tokenizers import Tokenizer

from holdfast.llm.bpe_trie import TrieBPE

FILE = "/opt/tokenizers/byte_bpe_50k.json"


def test_stable_pairs_are_those_that_plain_merging_keeps():
    bpe, draw = TrieBPE(FILE), random.Random(3)
    tokens = [t for t in bpe.token if len(bpe.token[t]) < 12]
    pairs = [(draw.choice(tokens), draw.choice(tokens)) for _ in range(3000)]
    pairs += list(draw.sample(sorted(bpe.merge), 500))  # these merge at once
    for a, b in pairs:
        assert bpe._stable(a, b) == (bpe._merged(bpe.token[a] + bpe.token[b]) == [a, b])


def test_pairs_of_a_large_text_stay_remembered():
    bpe, draw = TrieBPE(FILE), random.Random(4)
    tokens = sorted(bpe.token)
    wanted = set()
    while len(wanted) < 150_000:
        wanted.add((draw.choice(tokens), draw.choice(tokens)))
    for a, b in wanted:
        bpe._stable(a, b)
    assert all((a << 32) + b in bpe.pairs for a, b in wanted)


def test_single_words_and_mixed_chunks_equal_the_library():
    texts = ["The cat", " x", "x", "a's it's I'LL", "naïve ﬁ ab́c ªº", "a1b2 3c", " \tz  y\n", "don't", "A", "é e", "w0 w-w w_w ǅ", ""]
    library = Tokenizer.from_file(FILE)
    want = [b"".join(i.to_bytes(4, "little") for i in library.encode(t, add_special_tokens=False).ids) for t in texts]
    assert TrieBPE(FILE).encode(texts) == want
