"""One document of each group of near copies: five-word shingles, similarity (Jaccard) of 0.8 or more.

Method: BK-trees over SimHash fingerprints, as in ``simhash``, in shards that suit this similarity. Texts that agree in all words are one
node. Its fingerprint has ``WORDS`` words of 64 bits, each bit the majority over its shingles, and a pair of similarity 0.8 differs in 39 of
256 bits on average with a deviation of 6; trees are searched within ``RADIUS`` bits, which such a pair exceeds with a chance of 5e-13
(3e-8 for sets of four and five shingles). Bands of the fingerprint would hold two or three bits at that radius, so shards are made by the
shingles instead: every node has ``BANDS`` keys, each of ``ROWS`` least hashes, and a shard holds the nodes of one key. A pair of similarity 0.8 has
no shard in common with a chance of (1 - 0.8**5)**40 = 1.2e-7, a more similar pair with less. Every pair that a tree finds is verified by
the exact similarity of its shingles.

A shard of more than ``SMALL`` nodes gives no square of pairs as rows: its sets of shingles meet in one task, and only links between nodes that no link joins
yet leave it. All nodes are compared with ``PIVOTS`` of them first. Nodes of one group need no pair of their own, and neither do nodes whose distances to
one pivot differ by more than 0.2 (1 - similarity is a metric); the tree is asked for the others, and what it finds is verified through a list of
the shard's nodes by shingle. A shard whose sets exceed ``BLOCK_BYTES`` is dealt as pairs of blocks, so that a task stays small. Nothing is capped.

Defined results: words are split at whitespace, without regard to the case of ASCII letters; a text of fewer than five words is one
shingle, null and empty texts are equal. Groups are joined over chains of near copies. The row with the smallest doc_id stays.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import as_bytes, lean, stored
from holdfast.llm.components import connected_components
from holdfast.llm.simhash import SHARD, BKTree

SIZE = 5  # words of a shingle
BANDS, ROWS = 40, 5
SMALL = 32  # nodes of one key that are all paired
PIVOTS = 4
WORDS = 4  # 64-bit words of a fingerprint
BLOCK_BYTES = 1 << 23  # sets of one block of a large shard
RADIUS = 84  # bits in which fingerprints of a similar pair may differ
PRINT = [f"p{k}" for k in range(WORDS)]
_BLOCK = 1024  # shingles hashed at once
_ODD = np.uint64(0x9E3779B97F4A7C15)
_TURNS = (np.random.default_rng(42).integers(0, 2**63, BANDS * ROWS, dtype=np.uint64) << np.uint64(1)) | np.uint64(1)


def _mixed(value: np.ndarray) -> np.ndarray:
    value = (value ^ (value >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return value ^ (value >> np.uint64(32))


def shingles(words: list[bytes]) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the runs of five words."""
    codes = np.fromiter(map(xxhash.xxh64_intdigest, words), dtype=np.uint64, count=len(words))
    size = min(SIZE, len(words))
    n = len(words) - size + 1
    value = np.full(n, size, dtype=np.uint64)
    for k in range(size):
        value = value * _ODD + codes[k : k + n]
    return np.unique(_mixed(value))


def band_keys(values: np.ndarray) -> np.ndarray:
    """The keys of a set of shingles."""
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max, dtype=np.uint64)
    for at in range(0, len(values), _BLOCK):
        np.minimum(least, (_TURNS[:, None] * values[None, at : at + _BLOCK]).min(axis=1), out=least)
    key = np.arange(BANDS, dtype=np.uint64)
    for row in least.reshape(BANDS, ROWS).T:
        key = _mixed(key * _ODD + row)
    return key.view(np.int64)


def fingerprint(values: np.ndarray) -> np.ndarray:
    """SimHash of a set of shingles: each bit that is set in over half of them."""
    ones = np.zeros(64 * WORDS, dtype=np.int64)
    for at in range(0, len(values), _BLOCK):
        hashes = np.stack([_mixed(values[at : at + _BLOCK] * turn) for turn in _TURNS[:WORDS]], axis=1)
        ones += np.unpackbits(hashes.view(np.uint8), axis=1).sum(axis=0, dtype=np.int32)
    return np.packbits(2 * ones > len(values)).view(np.int64)


def _node(words: list[bytes]) -> int:
    return xxhash.xxh3_64_intdigest(b" ".join(words), 42)


@F.arrow_udf(T.LongType())
def _node_of(text: pa.Array) -> pa.Array:
    return pa.array(np.array([_node(t.lower().split()) for t in as_bytes(text)], dtype=np.uint64).view(np.int64))


def _prints(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        nodes, sizes, keys, prints = [], [], [], []
        for text in as_bytes(batch.column(1)):
            words = text.lower().split()
            values = shingles(words)
            nodes.append(_node(words))
            sizes.append(len(values))
            keys.append(band_keys(values))
            prints.append(fingerprint(values))
        bands = pa.ListArray.from_arrays(pa.array(np.arange(0, BANDS * len(keys) + 1, BANDS), pa.int32()), pa.array(np.concatenate(keys or [np.empty(0, np.int64)])))
        ids = np.array(nodes, dtype=np.uint64).view(np.int64)
        words = [pa.array(p) for p in np.array(prints, dtype=np.int64).reshape(-1, WORDS).T]
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids), pa.array(sizes, pa.int32()), bands, *words], names=["doc_id", "node", "size", "bands", *PRINT])


def _by_key(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, list[np.ndarray]]]:
    """Rows sorted by their first column: its values with the other columns."""
    held_key, held = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        key, *rest = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        for a, b in zip(starts, np.append(starts[1:], len(key))):
            if held and key[a] != held_key:
                yield held_key, [np.concatenate(c) for c in zip(*held)]
                held = []
            held_key = key[a]
            held.append([c[a:b] for c in rest])
    if held:
        yield held_key, [np.concatenate(c) for c in zip(*held)]


def _alike(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Whether sizes allow a similarity of 0.8."""
    return 5 * np.minimum(a, b).astype(np.int64) >= 4 * np.maximum(a, b).astype(np.int64)


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (key, node, size, fingerprint) sorted by key and node: pairs u < v that the shard's tree finds; of a key of many nodes
    each node, with the key."""
    us, vs, ks = [], [], []

    def out() -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(us)), pa.concat_arrays(vs), pa.concat_arrays(ks)], names=["u", "v", "key"])

    for key, (node, size, *words) in _by_key(batches):
        m = len(node)
        if m < 2:
            continue
        if m <= SMALL:
            prints = np.column_stack(words).view(np.uint64)
            b, a = BKTree(prints).search(prints, RADIUS)
            fit = (a < b) & _alike(size[a], size[b])
            us.append(node[a[fit]])
            vs.append(pa.array(node[b[fit]]))
            ks.append(pa.nulls(len(us[-1]), pa.int64()))
        else:
            us.append(node)
            vs.append(pa.nulls(m, pa.int64()))
            ks.append(pa.array(np.full(m, key)))
        if sum(map(len, us)) > 1 << 16:
            yield out()
            us, vs, ks = [], [], []
    if us:
        yield out()


def left_open(node: np.ndarray, inter: np.ndarray, total: np.ndarray, prints: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs of a key's nodes that its pivots do not settle; ``inter`` and ``total`` are by node and pivot. With ``prints``, only
    pairs that their trees find."""
    near, far = 5 * inter >= 4 * total, 1 - inter / total
    label = np.full(len(node), -1)
    for p in range(near.shape[1]):  # pivots that share a node are one group
        mine = near[:, p]
        old = np.unique(label[mine & (label >= 0)])
        label[mine | np.isin(label, old)] = p
    groups, counts = np.unique(label[label >= 0], return_counts=True)
    rest = np.flatnonzero(label != groups[counts.argmax()])
    is_rest, at = np.zeros(len(node), dtype=bool), np.arange(len(node))
    is_rest[rest] = True
    for lo in range(0, len(node) if len(rest) else 0, SHARD):
        part = slice(lo, lo + SHARD)
        tree = None if prints is None else BKTree(prints[part])
        for r in rest:
            open_ = (np.abs(far[part] - far[r]) <= 0.2 + 1e-9).all(axis=1) & (~is_rest[part] | (at[part] > r))
            if label[r] >= 0:
                open_ &= label[part] != label[r]
            if tree is not None and open_.any():
                found = np.zeros(len(open_), dtype=bool)
                found[tree.search(prints[r : r + 1], RADIUS)[1]] = True
                open_ &= found
            x = node[part][open_]
            if len(x):
                yield np.minimum(x, node[r]), np.maximum(x, node[r])


def shard_links(sets: list[np.ndarray]) -> Iterator[tuple[int, int]]:
    """Links between the sets of one shard, by position, that join them as all similar pairs do."""
    m, size = len(sets), np.array([len(s) for s in sets])
    _, code = np.unique(np.concatenate(sets), return_inverse=True)
    owner = np.repeat(np.arange(m), size)[np.argsort(code, kind="stable")]
    ends = np.cumsum(np.bincount(code))  # the nodes that have a shingle lie together in ``owner``
    mine = np.split(code, np.cumsum(size)[:-1])

    def common(at: int) -> np.ndarray:
        return np.bincount(np.concatenate([owner[ends[c - 1] if c else 0 : ends[c]] for c in mine[at]]), minlength=m)

    def similar(at: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        inter = common(at)
        total = size + size[at] - inter
        return 5 * inter >= 4 * total, inter, total

    group = np.arange(m)
    pivots = [similar(p) for p in range(min(PIVOTS, m))]
    prints = np.array([fingerprint(s) for s in sets]).view(np.uint64)
    inter, total = (np.stack([p[k] for p in pivots], axis=1) for k in (1, 2))

    def joined(at: int, others: np.ndarray) -> Iterator[tuple[int, int]]:
        for g, first in zip(*np.unique(group[others], return_index=True)):
            if g != group[at]:
                group[group == g] = group[at]
                yield at, int(others[first])

    for p, (near, _, _) in enumerate(pivots):
        yield from joined(p, np.flatnonzero(near))
    known, near = -1, None
    for a, b in left_open(np.arange(m), inter, total, prints):
        r = int(a[0]) if len(a) == 1 or a[0] == a[-1] else int(b[0])  # the end that all pairs have
        others = np.where(a == r, b, a)
        others = others[group[others] != group[r]]
        if len(others):
            if r != known:
                known, near = r, similar(r)[0]
            yield from joined(r, others[near[others]])


def _shard_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (shard, node, shingles) sorted by shard: links between the nodes of each."""
    for _, (node, held) in _by_key(batches):
        found = list(shard_links([np.frombuffer(h, dtype=np.uint64) for h in held]))
        if found:
            u, v = node[np.array(found).T]
            yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], names=["u", "v"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Shingles of the first row of each node; rows of a node are beside each other."""
    last = None
    for batch in batches:
        nodes = batch.column(0).to_pylist()
        first = [i for i, n in enumerate(nodes) if n != (nodes[i - 1] if i else last)]
        last = nodes[-1] if nodes else last
        kept = batch.take(pa.array(first, pa.int64()))
        found = [shingles(t.lower().split()).tobytes() for t in as_bytes(kept.column(1))]
        yield pa.RecordBatch.from_arrays([kept.column(0), pa.array(found, pa.binary())], names=["node", "held"])


def _measured(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        inter, total = [], []
        for a, b in zip(batch.column(2), batch.column(3)):
            x, y = (np.frombuffer(s.as_buffer(), dtype=np.uint64) for s in (a, b))
            both = np.concatenate([x, y])
            both.sort()
            common = int((both[1:] == both[:-1]).sum())
            inter.append(common)
            total.append(len(both) - common)
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(inter, pa.int64()), pa.array(total, pa.int64())], names=["u", "v", "inter", "total"])


def _verified(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    a, b = sets.toDF("u", "held_u"), sets.toDF("v", "held_v")
    both = pairs.join(a, "u").join(b, "v").select("u", "v", "held_u", "held_v")
    return stored(both.mapInArrow(lean(_measured), "u long, v long, inter long, total long"), "measured")


def links(known: DataFrame, texts: DataFrame) -> DataFrame:
    """Edges (u, v) that join the nodes of ``known`` (node, least, size, bands, fingerprint) as all similar pairs do; ``texts`` has (node, id, text) of all rows."""
    dealt = known.select(F.explode("bands").alias("key"), "node", "size", *PRINT).repartition("key").sortWithinPartitions("key", "node")
    pairs = stored(dealt.mapInArrow(lean(_pairs), "u long, v long, key long"), "pairs")
    needed = pairs.select(F.explode(F.array("u", "v")).alias("node")).where("node IS NOT NULL").distinct().join(known.select("node", "least"), "node")
    rows = texts.join(needed, (texts.node == needed.node) & texts.id.eqNullSafe(needed.least), "left_semi").select("node", "text")
    sets = stored(rows.repartition("node").sortWithinPartitions("node").mapInArrow(lean(_sets), "node long, held binary"), "sets")
    similar = _verified(pairs.where("v IS NOT NULL").select("u", "v").distinct(), sets).where("5 * inter >= 4 * total").select("u", "v")
    members = pairs.where("v IS NULL").select("key", F.col("u").alias("node"))
    if members.isEmpty():
        return similar
    hubs = members.join(sets, "node")
    blocks = hubs.groupBy("key").agg(F.ceil(F.sum(F.octet_length("held").cast("long")) / BLOCK_BYTES).cast("int").alias("n"))
    # a block meets each block of its shard, itself too if it is the only one
    dealt = hubs.join(blocks, "key").withColumn("b", F.expr("CAST(pmod(xxhash64(node), n) AS INT)")).withColumn("c", F.explode(F.expr("sequence(0, n - 1)")))
    dealt = dealt.where("n = 1 OR b <> c").select(F.xxhash64("key", F.least("b", "c"), F.greatest("b", "c")).alias("shard"), "node", "held")
    more = dealt.repartition("shard").sortWithinPartitions("shard", "node").mapInArrow(lean(_shard_links), "u long, v long")
    return similar.unionByName(more)


def keep_one_per_group(docs: DataFrame) -> DataFrame:
    """The rows of ``docs``, all columns as they are, less all but one of each group of near copies: that with the smallest
    doc_id stays (a null id counts as the largest; of rows that share the id, that with the least hash of all columns)."""
    marked = docs.select(F.struct("*").alias("row"), F.col("doc_id").alias("id"), _node_of("text").alias("node"))
    found = docs.select(F.col("doc_id").cast("long"), "text").mapInArrow(lean(_prints), "doc_id long, node long, size int, bands array<long>, " + ", ".join(f"{p} long" for p in PRINT))
    # equal texts have equal sizes, bands and fingerprints
    prints = stored(found, "prints")
    known = stored(prints.groupBy("node").agg(F.min("doc_id").alias("least"), F.first("size").alias("size"), F.first("bands").alias("bands"), *[F.first(p).alias(p) for p in PRINT]), "nodes")
    texts = marked.select("node", F.col("id").cast("long").alias("id"), F.col("row.text").alias("text"))
    comps = connected_components(links(known, texts)).withColumnRenamed("node", "member")
    rooted = known.join(comps, F.col("node") == F.col("member"), "left").select("node", "least", F.coalesce("root", "node").alias("root"))
    first = rooted.groupBy("root").agg(F.min(F.struct(F.col("least").isNull(), "least", "node")).alias("k"))
    sizes = prints.groupBy(F.col("node").alias("n"), F.col("doc_id").alias("i")).agg(F.count("*").alias("copies"))
    chosen = first.select(F.col("k.node").alias("kept_node"), F.col("k.least").alias("kept_id"))
    kept = stored(chosen.join(sizes, (F.col("kept_node") == F.col("n")) & F.col("kept_id").eqNullSafe(F.col("i"))).select("kept_node", "kept_id", "copies"), "kept")
    here = (F.col("node") == F.col("kept_node")) & F.col("id").cast("long").eqNullSafe(F.col("kept_id"))
    # a row passes one shuffle, as it is; only rows that share text and id are ranked
    out = marked.join(kept.where("copies = 1"), here, "left_semi").select("row.*")
    again = kept.where("copies > 1")
    if again.isEmpty():
        return out
    same = Window.partitionBy("node").orderBy(F.xxhash64(F.to_json("row")))
    ranked = marked.join(again, here, "left_semi").withColumn("rank", F.row_number().over(same)).where("rank = 1")
    return out.unionByName(ranked.select("row.*"))
