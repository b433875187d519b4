"""Byte-level BPE by one walk over a trie of the distinct words.

Method. The encoding of a prefix is known from its last token alone: it is the encoding of the prefix without that token,
plus the token. The last token of a prefix is the one token that ends it and whose pair with the last token before it is
stable, which means that merging the bytes of the two gives the same two again. The distinct words are put in order, which is
a depth-first walk of their trie: the states of a shared prefix are still on the stack and are computed once. Reading a
word's tokens off the stack from its end gives its encoding.

A worker remembers words, pairs and the ids of whole chunks, each up to a fixed number. Texts are cut at single spaces first,
since no pre-token spans white space that follows other text; texts with longer runs of white space are cut by the pattern.

Defined results: null or empty text has no tokens. The strings of special tokens in a text become their ids, as in the
library. Rows come out as they go in; other columns are ignored.
"""

from __future__ import annotations

import hashlib
import json
import struct
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from holdfast.llm.common import HELD, as_bytes, lean

#: How byte-level BPE splits a text before it merges (a fixed value of the tokenizer).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
_KNOWN = 150_000  # chunks, and pre-tokens, of a generation that a worker remembers
_PAIRS = 600_000  # pairs of tokens, about 60 MB


class Recent:
    """What was met lately: two generations, the older of which goes when the younger is full. What is met again is young again."""

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def missing(self, keys: set) -> set:
        """Keys that are not known; the others are young after this call and can be read from ``young``."""
        absent = keys - self.young.keys()
        if len(self.young) + len(absent) > self.size and self.young:
            self.young, self.old = {}, self.young
            absent = keys
        back = absent & self.old.keys()
        self.young.update((k, self.old[k]) for k in back)
        return absent - back


def byte_letters() -> dict[str, int]:
    """The letters by which vocabulary files write bytes: printable Latin-1 characters stand for themselves, the others
    follow from 256 on."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    rest = [b for b in range(256) if b not in plain]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(rest)}


class TrieBPE:
    """Encoder and decoder of one vocabulary file."""

    held: dict[str, "TrieBPE"] = {}

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            content = json.load(file)
        letter = byte_letters()
        model = content["model"]
        self.special = {t["content"]: t["id"] for t in content["added_tokens"]}
        self.token = {i: bytes(letter[c] for c in t) for t, i in model["vocab"].items() if t not in self.special}
        self.number = {b: i for i, b in self.token.items()}
        self.text = {**self.token, **{i: t.encode() for t, i in self.special.items()}}
        merges = [m if isinstance(m, list) else m.split(" ") for m in model["merges"]]
        self.merge = {}
        for rank, (a, b) in enumerate(merges):
            self.merge.setdefault((model["vocab"][a], model["vocab"][b]), (rank, model["vocab"][a + b]))
        # every string that ends a token, with its own number as a token, or -1
        self.endings = {t[k:]: self.number.get(t[k:], -1) for t in self.number for k in range(len(t))}
        self.split = regex.compile(PATTERN)
        self.parts = regex.compile("|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))) if self.special else None
        self.broad = regex.compile(r"\s ")
        self.pairs: dict[int, bool] = {}
        self.edges: dict[int, tuple[list, list] | None] = {}
        self.lefts: dict[int, dict[int, int]] = {}  # by right part of a merge: its left parts, with the ranks
        for (a, b), (rank, _) in self.merge.items():
            self.lefts.setdefault(b, {})[a] = rank
        born = {}
        for rank, t in self.merge.values():
            born[t] = max(rank, born.get(t, -1))
        # every merge comes after those that make its parts, so ranks never fall while a string is merged
        self.ordered = all(rank > max(born.get(a, -1), born.get(b, -1)) for (a, b), (rank, _) in self.merge.items())
        self.words, self.chunks = Recent(_KNOWN), Recent(_KNOWN)
        self.table = np.empty(max(self.text) + 1, object)  # bytes by id
        for i, t in self.text.items():
            self.table[i] = t

    @classmethod
    def of(cls, path: str) -> "TrieBPE":
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def _merged(self, data: bytes) -> list[int]:
        """Plain merging of a short string: always the pair of lowest rank, the leftmost first."""
        ids = [self.number[data[k : k + 1]] for k in range(len(data))]
        while len(ids) > 1:
            found = [(self.merge[p][0], k) for k, p in enumerate(zip(ids, ids[1:])) if p in self.merge]
            if not found:
                break
            _, k = min(found)
            ids[k : k + 2] = [self.merge[ids[k], ids[k + 1]][1]]
        return ids

    def _edges(self, token: int) -> tuple[list, list] | None:
        """What stands at the right and at the left end of a token while it is merged from its bytes: tokens with the rank of the
        merge that ends them. None if its bytes become something else."""
        found = self.edges.get(token, 0)
        if found != 0:
            return found
        nodes = [(self.number[self.token[token][k : k + 1]], -1, None, None) for k in range(len(self.token[token]))]
        while len(nodes) > 1:
            fits = [(self.merge[p][0], k) for k, p in enumerate((a[0], b[0]) for a, b in zip(nodes, nodes[1:])) if p in self.merge]
            if not fits:
                break
            rank, k = min(fits)
            nodes[k : k + 2] = [(self.merge[nodes[k][0], nodes[k + 1][0]][1], rank, nodes[k], nodes[k + 1])]
        found = None
        if len(nodes) == 1 and nodes[0][0] == token:
            found = ([], [])
            for side, spine in ((3, found[0]), (2, found[1])):
                node, ends = nodes[0], len(self.merge)
                while node:
                    spine.append((node[0], ends))
                    node, ends = node[side], node[1]
        self.edges[token] = found
        return found

    def _stable(self, before: int, token: int) -> bool:
        """Whether ``token`` may follow ``before`` (-1: the start of a word)."""
        key = (before << 32) + token
        known = self.pairs.get(key)
        if known is None:
            if len(self.pairs) >= _PAIRS:
                self.pairs.clear()
            if not self.ordered:
                whole = [token] if before < 0 else [before, token]
                known = self._merged(b"".join(self.token[t] for t in whole)) == whole
            else:
                # merges go by rank: two ends merge if their rank comes before both are used up, the left one first in a tie
                own = self._edges(token)
                known = own is not None
                if known and before >= 0:
                    for y, j in own[1]:
                        lefts = self.lefts.get(y)  # what merges with y on its right: few tokens, so most ends are passed over here
                        if lefts is None:
                            continue
                        for x, i in self._edges(before)[0]:
                            rank = lefts.get(x)
                            if rank is not None and rank < i and rank <= j:
                                known = False
                                break
                        if not known:
                            break
            self.pairs[key] = known
        return known

    def _encode_words(self, words: list[bytes]) -> None:
        """Add distinct words to ``self.words``, walking their trie depth first."""
        last = [-1]  # the last token of each prefix on the stack
        length = [0]
        previous = b""
        ending, stable, known = self.endings.get, self.pairs.get, self.words.young
        for word in sorted(words):
            shared = 0
            for a, b in zip(previous, word):
                if a != b:
                    break
                shared += 1
            del last[shared + 1 :], length[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                fitting = []
                for start in range(end - 1, -1, -1):
                    t = ending(word[start:end])
                    if t is None:
                        break
                    if t >= 0:
                        fitting.append((t, start))
                for t, start in reversed(fitting):
                    before = last[start]
                    fits = stable((before << 32) + t)
                    if self._stable(before, t) if fits is None else fits:
                        last.append(t)
                        length.append(end - start)
                        break
                else:
                    raise ValueError("the vocabulary lacks a byte")
            ids, at = [], len(word)
            while at:
                ids.append(last[at])
                at -= length[at]
            known[word] = struct.pack(f"<{len(ids)}I", *reversed(ids))
            previous = word

    def _cut(self, text: str) -> list[str]:
        """Chunks whose pre-tokens are those of the text."""
        if self.broad.search(text):
            return self.split.findall(text)
        first, *others = text.split(" ")
        chunks = [" " + x for x in others]
        return [first, *chunks] if first else chunks

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids per text as little-endian unsigned 32-bit integers."""
        cut = []  # per text, lists of chunks between special tokens, and the ids of those
        for text in texts:
            found = self.parts.findall(text) if self.parts and any(t in text for t in self.special) else []
            cut.append(([self._cut(x) for x in (self.parts.split(text) if found else [text])], found))
        fresh = self.chunks.missing(set().union(*(c for pieces, _ in cut for c in pieces)))
        split = self.split.findall
        # ASCII letters behind one space, or none, are one pre-token
        tokens = {c: [c.encode()] if c.isascii() and c[1:].isalpha() and (c[0] == " " or c[0].isalpha()) else [w.encode() for w in split(c)] for c in fresh}
        self._encode_words(list(self.words.missing(set().union(*tokens.values()))))
        word, chunks = self.words.young.__getitem__, self.chunks.young
        chunks.update((c, word(ws[0]) if len(ws) == 1 else b"".join(map(word, ws))) for c, ws in tokens.items())
        chunk = chunks.__getitem__
        out = []
        for pieces, found in cut:
            ids = [b"".join(map(chunk, pieces[0]))]
            for special, piece in zip(found, pieces[1:]):
                ids.append(self.special[special].to_bytes(4, "little"))
                ids.extend(map(chunk, piece))
            out.append(b"".join(ids))
        return out

    def decode(self, ids: bytes) -> str:
        """Text of ids, special tokens included."""
        return b"".join(self.table[np.frombuffer(ids, "<u4")].tolist()).decode("utf-8", "replace")


_REPORT = pa.schema([("doc_id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())])
_TEXT = 2_000_000  # bytes of text encoded at once


HELD["bpe"] = TrieBPE.held


def _coded(tokenizer: str):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = TrieBPE.of(tokenizer)
        for batch in batches:
            texts = as_bytes(batch.column(1))
            lo = 0
            while lo < len(texts):
                hi, taken = lo, 0
                while hi < len(texts) and (taken == 0 or taken + len(texts[hi]) <= _TEXT):
                    taken += len(texts[hi])
                    hi += 1
                coded = bpe.encode([t.decode() for t in texts[lo:hi]])
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(lo, hi - lo),
                        pa.array([len(c) // 4 for c in coded], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                        pa.array([hashlib.sha256(bpe.decode(c).encode()).hexdigest() for c in coded]),
                    ],
                    schema=_REPORT,
                )
                lo = hi

    return run


def encoding_report(docs: DataFrame, tokenizer: str) -> DataFrame:
    """(doc_id, n_tokens, ids_sha256, decoded_sha256) per row of ``docs``; ``tokenizer`` is a byte-level BPE file that every
    executor has."""
    texts = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return texts.mapInArrow(lean(_coded(tokenizer), "bpe"), "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")
