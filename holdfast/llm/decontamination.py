"""Benchmark decontamination by SimHash windows of the size of an item.

A document leaks an item if one of its windows of as many words as the item has is similar to it: weighted Jaccard
similarity of the five-word shingles (weight: how often a shingle occurs) of ``SIMILARITY`` or more. A document of fewer
words than the item is one window. Words are runs of letters, digits and underscores in lower case, so case, punctuation
and line breaks don't matter.

Method, in three steps per block of items:

* A similar window shares most of its shingles with one item. Windows that hold too few shingles of any item to reach the
  similarity are left out, which loses nothing.
* The other windows get a 64-bit SimHash over their shingles, as the items have. A multi-index finds all items within
  ``RADIUS`` bits: the bits are cut in ``RADIUS // 3 + 1`` blocks, so one block differs in two bits at most, and every block
  value within two bits of a window's is looked up. No item within the radius is missed.
* Candidates are verified by the exact similarity of the multisets of shingles.

The benchmark is cut in blocks of at most ``BLOCK_CHARS`` characters of text (longer items make a block of their own); each
block is broadcast and compared with all documents in one pass, so what is broadcast is bounded whatever the benchmark's
size. A text is one row, so no document group meets in one task.

Defined results: items with null text or without words leak nowhere; an item of fewer than five words is one shingle, which
leaks where the same words follow each other; a document of fewer than five words leaks such items only. Null
or empty documents leak nothing. Repeated rows give repeated results; other columns are ignored. Empty tables give an empty
result.
"""

from __future__ import annotations

import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import tidy

SIZE = 5
SIMILARITY = 0.8
RADIUS = 20
BLOCK_CHARS = 2_000_000
_WORD = re.compile(r"\w+")
_ROUND = 20_000  # windows whose fingerprints are made at once
_PAIRS = 1_000_000  # candidate pairs of a lookup in one block at most


def words_of(text: str | None) -> list[str]:
    return _WORD.findall((text or "").lower())


def shingles_of(words: list[str]) -> np.ndarray:
    """64-bit hashes of the shingles, in order."""
    if not words:
        return np.empty(0, np.uint64)
    n = max(1, len(words) - SIZE + 1)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, " ".join(words).encode().split(b" ")), np.uint64, count=len(words))
    out = np.zeros(n, np.uint64)
    for k in range(min(SIZE, len(words))):  # the order of the words counts
        out = (out ^ hashes[k : k + n]) * np.uint64(0x9E3779B97F4A7C15)
        out ^= out >> np.uint64(31)
    return out


def _signs(hashes: np.ndarray) -> np.ndarray:
    bits = np.unpackbits(np.ascontiguousarray(hashes).view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    return bits.astype(np.int32) * 2 - 1


def _packed(sums: np.ndarray) -> np.ndarray:
    return np.packbits(sums > 0, axis=1, bitorder="little").view(np.uint64).reshape(-1)


def similarity(a: Counter, b: Counter) -> float:
    """Weighted Jaccard similarity of two multisets of shingles."""
    common = sum(min(n, b[s]) for s, n in a.items() if s in b)
    return common / (a.total() + b.total() - common) if a or b else 0.0


class MultiIndex:
    """All values within a Hamming radius of queries, by lookups of blocks of bits. Each value is filed, per block, under every
    block value within two bits of its own, so a query is looked up once a block."""

    def __init__(self, values: list[int], radius: int):
        self.values, self.radius = np.array(values, np.uint64), radius
        blocks = radius // 3 + 1  # radius bits over so many blocks: one block has two at most
        edges = np.linspace(0, 64, blocks + 1).astype(int)
        self.blocks = []
        for shift, width in ((int(a), int(b - a)) for a, b in zip(edges, edges[1:])):
            mask = np.uint64((1 << width) - 1)
            flips = [0, *(1 << i for i in range(width)), *((1 << i) | (1 << j) for i, j in combinations(range(width), 2))]
            keys = (((self.values >> np.uint64(shift)) & mask)[:, None] ^ np.array(flips, np.uint64)).reshape(-1)
            order = np.argsort(keys, kind="stable")
            self.blocks.append((np.uint64(shift), mask, keys[order], order // len(flips)))

    def search(self, queries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(place of the query, place of the value) of all pairs within the radius, in this order."""
        step = max(1, _PAIRS // max(1, len(self.values)))
        found = [self._near(queries[lo : lo + step], lo) for lo in range(0, len(queries), step)]
        pairs = np.concatenate([np.empty(0, np.int64), *found])
        return pairs // max(1, len(self.values)), pairs % max(1, len(self.values))

    def _near(self, queries: np.ndarray, first: int) -> np.ndarray:
        pairs = []
        for shift, mask, keys, owners in self.blocks:
            part = (queries >> shift) & mask
            lo = np.searchsorted(keys, part, "left")
            n = np.searchsorted(keys, part, "right") - lo
            query = np.repeat(np.arange(len(queries)), n)
            value = owners[np.arange(len(query)) + np.repeat(lo - np.cumsum(n) + n, n)]
            near = np.bitwise_count(queries[query] ^ self.values[value]) <= self.radius
            pairs.append((query[near] + first) * len(self.values) + value[near])
        return np.unique(np.concatenate(pairs))


class Items:
    """One block of benchmark items, ready to be compared with documents."""

    def __init__(self, rows: list[tuple[int, str]], least: float = SIMILARITY, radius: int = RADIUS):
        self.least = least
        ready = [(i, w) for i, t in rows if (w := words_of(t))]
        self.ids = [i for i, _ in ready]
        self.counts = [Counter(shingles_of(w).tolist()) for _, w in ready]
        self.known = np.unique(np.array([s for c in self.counts for s in c], np.uint64))
        prints = [int(_packed(_signs(shingles_of(w)).sum(axis=0, keepdims=True))[0]) for _, w in ready]
        by_length = defaultdict(list)
        for n, (_, w) in enumerate(ready):
            by_length[len(w)].append(n)
        self.lengths = {k: (ns, MultiIndex([prints[n] for n in ns], radius)) for k, ns in sorted(by_length.items())}

    def _windows(self, hits: np.ndarray, n_words: int, length: int) -> np.ndarray:
        """Starts of the windows of ``length`` words with enough shingles of items to be similar to one."""
        mine = length - SIZE + 1
        size = min(mine, len(hits))
        if n_words < SIZE or size < self.least * mine:
            return np.empty(0, np.int64)
        # similarity >= s needs s / (1 + s) of the shingles of both windows in common
        need = max(1, int(np.ceil(self.least / (1 + self.least) * (size + mine) - 1e-9)))
        total = np.concatenate([[0], np.cumsum(hits)])
        return np.flatnonzero(total[size:] - total[:-size] >= need)

    def leaks(self, text: str) -> list[tuple[int, int, float]]:
        """(item, first word, similarity) of the most similar window per item that the text leaks; the first of equals."""
        words = words_of(text)
        if not words or not self.ids:
            return []
        hashes = shingles_of(words)
        at = np.searchsorted(self.known, hashes).clip(max=len(self.known) - 1)
        hits = self.known[at] == hashes
        short = min(self.lengths) < min(SIZE, len(words) + 1)
        if not hits.any() and not short:
            return []
        best: dict[int, tuple[float, int]] = {}
        for length, (items, index) in self.lengths.items():
            if length < SIZE:  # an item of fewer words is one shingle of its own size
                for n, s in self._short(words, length, items):
                    best.setdefault(n, (1.0, s))
                continue
            size = min(length - SIZE + 1, len(hashes))
            starts = self._windows(hits, len(words), length)
            for lo in range(0, len(starts), _ROUND):
                part = starts[lo : lo + _ROUND]
                first = part[0]
                signs = _signs(hashes[first : part[-1] + size]) if part[-1] - first < 4 * _ROUND else None
                if signs is not None:
                    sums = np.concatenate([np.zeros((1, 64), np.int32), np.cumsum(signs, axis=0, dtype=np.int32)])
                    prints = _packed(sums[part - first + size] - sums[part - first])
                else:
                    prints = np.concatenate([_packed(_signs(hashes[s : s + size]).sum(axis=0, keepdims=True)) for s in part])
                at, window = -1, Counter()
                for place, n in zip(*(x.tolist() for x in index.search(prints))):
                    if place != at:
                        at, start = place, int(part[place])
                        window = Counter(hashes[start : start + size].tolist())
                    alike = similarity(window, self.counts[items[n]])
                    if alike >= self.least and alike > best.get(items[n], (0.0, 0))[0]:
                        best[items[n]] = (alike, start)
        return [(self.ids[n], start, alike) for n, (alike, start) in sorted(best.items())]

    def _short(self, words: list[str], length: int, items: list[int]) -> Iterator[tuple[int, int]]:
        wanted = {next(iter(self.counts[n])) for n in items}
        for start in range(len(words) - length + 1):
            h = int(shingles_of(words[start : start + length])[0])
            if h in wanted:
                for n in items:
                    if h in self.counts[n]:
                        yield n, start


def item_blocks(benchmark: DataFrame) -> list[list[tuple[int, str]]]:
    """The benchmark in blocks of bounded text, read one after the other."""
    blocks, held, size = [], [], 0
    for row in benchmark.select(F.col("item_id").cast("long"), F.col("text").cast("string")).where("text IS NOT NULL").toLocalIterator():
        if held and size + len(row[1]) > BLOCK_CHARS:
            blocks.append(held)
            held, size = [], 0
        held.append((row[0], row[1]))
        size += len(row[1])
    return [*blocks, held] if held else blocks


_LEAKS = T.ArrayType(
    T.StructType([T.StructField("item_id", T.LongType()), T.StructField("first_word", T.IntegerType()), T.StructField("similarity", T.DoubleType())])
)
_LEAK = pa.struct([("item_id", pa.int64()), ("first_word", pa.int32()), ("similarity", pa.float64())])


def leak_column(spark, rows: list[tuple[int, str]], least: float = SIMILARITY, radius: int = RADIUS):
    """Function of a text column: the leaks of one block of items."""
    block = spark.sparkContext.broadcast(rows)
    ready: dict[str, Items] = {}

    @F.arrow_udf(_LEAKS)
    def leaks(text: pa.Array) -> pa.Array:
        tidy()
        if "items" not in ready:
            ready["items"] = Items(block.value, least, radius)
        found = [[dict(zip(("item_id", "first_word", "similarity"), x)) for x in ready["items"].leaks(t or "")] for t in text.to_pylist()]
        return pa.array(found, pa.list_(_LEAK))

    return leaks


def find_leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """(doc_id, item_id, first_word, similarity) per leaked item and row of ``docs``."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    parts = [
        texts.select("doc_id", F.explode(leak_column(spark, rows, least, radius)("text")).alias("x")).select("doc_id", "x.*")
        for rows in item_blocks(benchmark)
    ]
    if not parts:
        return spark.createDataFrame([], "doc_id long, item_id long, first_word int, similarity double")
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def without_leaks(docs: DataFrame, benchmark: DataFrame, least: float = SIMILARITY, radius: int = RADIUS) -> DataFrame:
    """The rows of ``docs``, all columns as they are, that leak no item."""
    for rows in item_blocks(benchmark):
        leaks = leak_column(docs.sparkSession, rows, least, radius)
        docs = docs.where(F.size(leaks(F.col("text").cast("string"))) == 0)
    return docs
