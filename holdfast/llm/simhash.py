"""Near-duplicates by SimHash fingerprints and BK-trees.

Method: a BK-tree keeps the children of a node by their integer Hamming distance to it, and a search follows only
the edges within the radius of the query's own distance. The trees are shards. Two fingerprints that differ in at
most two bits agree wholly on one of three bands, so a shard holds the fingerprints with one band value, and
exactly the queries with that value are sent to it. Trees of all shards together grow with the corpus, so a
shuffle on the band value brings tree and queries together; no tree is broadcast. A band value with more than
``SHARD`` fingerprints is split again by three bands of its remaining bits, which loses nothing for the same reason.

Defined results: null or empty text, or one without words, has fingerprint zero and is linked like any other.
Repeated rows and repeated ids each give a row; a group whose ids are all null has a null id. Other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import as_bytes, stored
from holdfast.llm.components import connected_components

RADIUS = 2
SHARD = 4096  # fingerprints in one tree
BANDS = ((42, 22), (21, 21), (0, 21))  # (shift, width): RADIUS + 1 bands cover the 64 bits
_BLOCK = 1 << 16  # shingles whose bits are counted at once


def fingerprint(text: bytes, size: int = 3) -> int:
    """SimHash of a UTF-8 text: the majority of each bit over the XXH64 (seed 42) of its word shingles."""
    words = text.lower().split()  # on bytes both know ASCII only
    if not words:
        return 0
    grams = map(b" ".join, zip(*(words[k:] for k in range(size)))) if len(words) >= size else iter([b" ".join(words)])
    n = max(1, len(words) - size + 1)
    hashes = np.fromiter((xxhash.xxh64_intdigest(g, 42) for g in grams), dtype="<u8", count=n)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, n, _BLOCK):
        part = hashes[at : at + _BLOCK]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > n, bitorder="little").tobytes(), "little")


@F.arrow_udf(T.LongType())
def fingerprint_of(text: pa.Array) -> pa.Array:
    """The fingerprint's 64 bits as a signed long."""
    return pa.array(np.array([fingerprint(t) for t in as_bytes(text)], dtype=np.uint64).view(np.int64))


def _bits(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Bits that differ; a value is a word or a row of words."""
    apart = np.bitwise_count(a ^ b)
    return apart if apart.ndim == 1 else apart.sum(axis=1, dtype=np.int64)


class BKTree:
    """BK-tree over 64-bit values, or over rows of such words, built and searched level by level over whole arrays."""

    def __init__(self, values: np.ndarray):
        self.values = values
        self.bits = 64 * (values.shape[1] if values.ndim > 1 else 1)
        self.child = np.full((len(values), self.bits + 1), -1, dtype=np.int32)
        waiting = np.arange(1, len(values))
        node = np.zeros(len(waiting), dtype=np.int64)
        flat = self.child.reshape(-1)
        while len(waiting):
            edge = node * (self.bits + 1) + _bits(values[waiting], values[node])
            taken, first = np.unique(edge, return_index=True)
            free = flat[taken] < 0
            flat[taken[free]] = waiting[first[free]]  # the first to arrive becomes the child
            node = flat[edge].astype(np.int64)
            stay = node != waiting
            waiting, node = waiting[stay], node[stay]

    def search(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (query index, value index) at ``radius`` or less."""
        asked, node = np.arange(len(queries)), np.zeros(len(queries), dtype=np.int64)
        found_q, found_v = [], []
        while len(asked):
            far = _bits(queries[asked], self.values[node]).astype(np.int64)
            near = far <= radius
            found_q.append(asked[near])
            found_v.append(node[near])
            ways = np.arange(-radius, radius + 1) + far[:, None]
            down = np.where((ways >= 0) & (ways <= self.bits), self.child[node[:, None], ways.clip(0, self.bits)], -1)
            at, _ = np.nonzero(down >= 0)
            asked, node = asked[at], down[down >= 0].astype(np.int64)
        return np.concatenate([*found_q, np.empty(0, np.int64)]), np.concatenate([*found_v, np.empty(0, np.int64)])


def _linked(values: np.ndarray, radius: int) -> np.ndarray:
    """For each value of a shard the position of the first value that it can reach by links inside the shard."""
    label = np.arange(len(values))
    shards = [(at, BKTree(values[at : at + SHARD])) for at in range(0, len(values), SHARD)]
    while True:
        before = label.copy()
        for at, tree in shards:
            for lo in range(at, len(values), 512):  # a link between two trees is found from the later one
                q, v = tree.search(values[lo : lo + 512], radius)
                least = np.minimum(label[q + lo], label[v + at])
                np.minimum.at(label, q + lo, least)
                np.minimum.at(label, v + at, least)
        while (label[label] != label).any():
            label = label[label]
        if (label == before).all():
            return label


_EDGES = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _shard_edges(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, fp) sorted by key: search each shard and link every member to the first of its links."""
    held_key, held = None, []

    def flush():
        values = np.unique(np.concatenate(held)).view(np.uint64)
        if len(values) < 2:
            return None
        label = _linked(values, RADIUS)
        apart = label != np.arange(len(values))
        if not apart.any():
            return None
        ends = values.view(np.int64)
        return pa.RecordBatch.from_arrays([pa.array(ends[label[apart]]), pa.array(ends[apart])], schema=_EDGES)

    for batch in batches:
        if not batch.num_rows:
            continue
        key, fp = batch.column(0).to_numpy(), batch.column(1).to_numpy()
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for a, b in zip(starts, np.append(starts[1:], len(key))):
            if held and key[a] != held_key:
                if sum(map(len, held)) > 1 and (out := flush()) is not None:
                    yield out
                held = []
            held_key = key[a]
            held.append(fp[a:b])
    if sum(map(len, held)) > 1 and (out := flush()) is not None:
        yield out


def _band(shift: int, width: int) -> F.Column:
    return F.shiftrightunsigned("fp", shift).bitwiseAND((1 << width) - 1)


def links(prints: DataFrame) -> DataFrame:
    """Edges (u, v) that join the distinct fingerprints of ``prints`` exactly as all links at RADIUS or less do."""
    keys = [F.struct(F.lit(n).alias("band"), _band(*b).alias("value")) for n, b in enumerate(BANDS)]
    dealt = prints.select("fp").distinct().select("fp", F.explode(F.array(*keys)).alias("k")).select("fp", "k.band", "k.value")
    sizes = dealt.groupBy("band", "value").count().where(F.col("count") > SHARD).drop("count")
    split = []
    for n, (shift, width) in enumerate(BANDS):  # the bits outside a band, again in three bands
        rest = F.col("fp").bitwiseAND((1 << shift) - 1).bitwiseXOR(
            F.shiftleft(F.shiftrightunsigned("fp", shift + width), shift) if shift + width < 64 else F.lit(0)
        )
        third = (64 - width) // 3
        for part in range(3):
            value = F.shiftrightunsigned(rest, part * third)
            split.append((n, part, value.bitwiseAND((1 << third) - 1) if part < 2 else value))
    if sizes.isEmpty():
        keyed = dealt.select(F.xxhash64("band", "value").alias("key"), "fp", "band", "value")
    else:
        known = dealt.join(sizes.withColumn("large", F.lit(True)), ["band", "value"], "left")
        parts = F.coalesce(*[F.when(F.col("band") == n, F.array(*[F.struct(F.lit(p).alias("part"), v.alias("sub")) for m, p, v in split if m == n])) for n in range(3)])
        whole = F.array(F.struct(F.lit(-1).alias("part"), F.lit(0).cast("long").alias("sub")))
        keyed = known.withColumn("s", F.explode(F.when(F.col("large"), parts).otherwise(whole))).select(
            F.xxhash64("band", "value", "s.part", "s.sub").alias("key"), "fp", "band", "value"
        )
    # equal keys of different shards (a chance of 2^-64 each) only make a shard larger
    return keyed.select("key", "fp").repartition("key").sortWithinPartitions("key").mapInArrow(_shard_edges, "u long, v long")


def _labels(prints: DataFrame) -> DataFrame:
    """(fp, root, kept_id, kept_fp, component_id) per distinct fingerprint; kept_* name the row that stands for its group."""
    known = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    comps = connected_components(links(prints))
    rooted = known.join(comps, known.fp == comps.node, "left").select("fp", "least", F.coalesce("root", "fp").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "fp")).alias("k"))
    return rooted.join(first, "root").select(
        "fp", "root", F.col("k.fp").alias("kept_fp"), F.col("k.least").alias("component_id")
    )


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """(doc_id, fp, component_id) per row of ``docs`` (doc_id, text); ``component_id`` is the smallest doc_id of the group."""
    prints = stored(docs.select(F.col("doc_id").cast("long"), fingerprint_of("text").alias("fp")), "prints")
    return prints.join(_labels(prints), "fp").select("doc_id", "fp", "component_id")


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, less all but one of each near-duplicate group: that with the
    smallest doc_id stays (a null id counts as the largest; of rows that share the id, the smallest in all columns)."""
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), fingerprint_of("text").alias("fp"))
    prints = stored(marked.select(F.col("id").cast("long").alias("doc_id"), "fp"), "prints")
    kept = _labels(prints).where("fp = kept_fp").select("fp", "component_id")
    mine = marked.join(kept, "fp").where(F.col("id").eqNullSafe(F.col("component_id")))
    return mine.groupBy("fp").agg(F.min("row").alias("row")).select("row.*")
