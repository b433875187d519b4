"""Prefix trie of conversations: padded matrices of turn ids, sorted and compared column by column.

Method. A turn's id is the MD5 of its role and text, a conversation the string of its turns' ids. Spark sorts these strings (with
the conversation's id) over ranges, and every task cuts its range into blocks. A block becomes a matrix of dense turn ids, a row for
each conversation, padded with zeros, and numpy's lexsort orders it. Where a column differs from the row above the mask of that column is
set; masks are OR-accumulated from left to right, so a set mask marks the start of a node at every depth at once, and ``reduceat`` over the
starts sums each depth: members, ends and children downwards, subtrees from the deepest column up.

Nodes that neither the first nor the last row of a block passes are whole. The others, two paths of a block, may go on in the
neighbouring blocks: their parts leave the block under the hash of their path and are summed over blocks. Subtree sums of such a node are
those of its parts plus the own values of the boundary nodes below, each of which is added along one path that holds it, in one
running sum from the deepest node up. The ids of conversations that end in a boundary node are hashed as a stream of sorted pieces.

Sizes: a block holds at most ``CELLS`` cells and ``ROWS`` conversations (a longer conversation is a block of its own), so memory
follows neither the range nor equal conversations; a conversation's turn ids, 16 bytes each, are one row; texts are hashed where they are
read and never moved. A path of a third of all conversations is in many blocks, which give one part each.

Defined results: turns are ordered by number (null first), then role, then id; null role and text are empty. Rows without conv_id are
in no conversation. Repeated rows are repeated turns. An empty table has no nodes, not even a root. Further columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import stored

CELLS = 1 << 20  # cells of a block's matrix
ROWS = 1 << 15  # conversations of a block
PIECE = 4096  # ids of a piece that is hashed later
WORD = r"[^\x20\x09-\x0D]+"
FAMILY, HEADS = 20, 4  # conversations that share a beginning; its length is below HEADS
_ID = 16


def turns_of(rows: DataFrame) -> DataFrame:
    """(conv_id, turn, role, id, words) of conversation rows."""
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    ident = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return rows.where("conv_id IS NOT NULL").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", role.alias("role"), ident.alias("id"), F.regexp_count(text, F.lit(WORD)).alias("words")
    )


def _in_order() -> Column:
    """The turns of a group, sorted: unknown numbers first."""
    return F.array_sort(F.collect_list(F.struct(F.col("turn").isNotNull().alias("known"), "turn", "role", "id", "words")))


def _sequence(turns: str) -> list[Column]:
    path = F.unhex(F.array_join(F.transform(turns, lambda t: F.hex(t["id"])), ""))
    return [path.alias("path"), F.transform(turns, lambda t: t["words"]).alias("words")]


def conversations_of(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words): the turns of each conversation in order."""
    return turns.groupBy("conv_id").agg(_in_order().alias("turns")).select("conv_id", *_sequence("turns"))


def rebuilt(turns: DataFrame) -> DataFrame:
    """(conv_id, path, words) where conversation c begins with the first h turns of c - c % 20 and goes on with its own turns after
    its first h, h = crc32(c) % 4. Families are dealt whole, so that the beginning needs no join."""
    family = F.col("conv_id") - F.col("conv_id") % FAMILY
    held = turns.withColumn("family", family).repartition("family").groupBy("family", "conv_id").agg(_in_order().alias("turns"))
    head = F.max(F.when(F.col("conv_id") == F.col("family"), F.slice("turns", 1, HEADS - 1))).over(Window.partitionBy("family"))
    h = (F.crc32(F.col("conv_id").cast("string").cast("binary")) % HEADS).cast("int")
    none = F.slice("turns", 1, 0)
    begun = held.withColumn("head", F.slice(F.coalesce(head, none), F.lit(1), h)).withColumn("rest", F.slice("turns", h + 1, F.greatest(F.size("turns") - h, F.lit(0))))
    return begun.withColumn("whole", F.concat("head", "rest")).select("conv_id", *_sequence("whole"))


def _sha(ids: list[int]) -> str:
    return hashlib.sha256(",".join(map(str, ids)).encode()).hexdigest()


def _chain(path: bytes) -> list[bytes]:
    """The hash of each beginning of a path, that of the root first."""
    out = [hashlib.md5(b"").digest()]
    for at in range(0, len(path), _ID):
        out.append(hashlib.md5(out[-1] + path[at : at + _ID]).digest())
    return out


_KINDS = {
    "conv_id": pa.int64(), "depth": pa.int64(), "parent_conv_id": pa.int64(), "n_convs": pa.int64(), "n_children": pa.int64(), "n_leaves": pa.int64(),
    "saved_tokens": pa.int64(), "ends_sha256": pa.string(), "block": pa.int64(), "side": pa.int32(), "key": pa.binary(), "parent_key": pa.binary(),
    "words": pa.int64(), "pieces": pa.list_(pa.struct([("first", pa.int64()), ("ids", pa.string())])),
}
_SHAPE = (
    "conv_id long, depth long, parent_conv_id long, n_convs long, n_children long, n_leaves long, saved_tokens long, ends_sha256 string,"
    " block long, side int, key binary, parent_key binary, words long, pieces array<struct<first: long, ids: string>>"
)


def _block(conv: np.ndarray, paths: list[bytes], words: list[list[int]]) -> pa.RecordBatch:
    """The nodes of a block: whole ones, then the parts on the paths of its first and last row (``side`` 0 and 1)."""
    sizes = np.array([len(p) // _ID for p in paths])
    n, depth = len(conv), int(sizes.max())
    turns = np.frombuffer(b"".join(paths), dtype=f"S{_ID}") if depth else np.empty(0, f"S{_ID}")
    # bytes that end in zeros compare as padded ones do, so order and equality hold
    dense = np.unique(turns, return_inverse=True)[1] + 1
    held = np.arange(depth)[None, :] < sizes[:, None]
    matrix, counts = np.zeros((n, depth), np.int64), np.zeros((n, depth), np.int64)
    matrix[held] = dense
    counts[held] = np.concatenate([np.asarray(w, np.int64) for w in words]) if depth else []
    order = np.lexsort((conv, *matrix.T[::-1]))
    matrix, counts, conv, sizes = matrix[order], counts[order], conv[order], sizes[order]
    change = np.ones((n, depth), bool)
    change[1:] = matrix[1:] != matrix[:-1]
    change = np.logical_or.accumulate(change, axis=1)

    block, chains = int(conv[0]), [_chain(paths[order[0]]), _chain(paths[order[-1]])]
    rows: dict[str, list] = {name: [] for name in _KINDS}

    def put(**columns) -> None:
        many = len(columns["conv_id"])
        for name in _KINDS:
            rows[name].append(columns.get(name, [None] * many))

    leaves, saved, inner = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)  # of the nodes one deeper, at their first row
    for d in range(depth, -1, -1):
        starts = np.flatnonzero(change[:, d - 1]) if d else np.zeros(1, np.int64)
        real = matrix[starts, d - 1] > 0 if d else np.ones(1, bool)
        members = np.diff(np.append(starts, n))
        least = np.minimum.reduceat(conv, starts)
        child = (change[:, d] & (matrix[:, d] > 0)) if d < depth else np.zeros(n, bool)
        children = np.add.reduceat(child.astype(np.int64), starts)
        whole_children = np.add.reduceat((child & inner).astype(np.int64), starts)
        ended = np.add.reduceat((sizes == d).astype(np.int64), starts)
        own_words = counts[starts, d - 1] if d else np.zeros(1, np.int64)
        edge = np.zeros(len(starts), bool)
        edge[[0, -1]] = True
        below_leaves, below_saved = np.add.reduceat(leaves, starts), np.add.reduceat(saved, starts)
        all_leaves = below_leaves + np.where(edge, 0, children == 0)
        all_saved = below_saved + np.where(edge, 0, (members - 1) * own_words)
        leaves, saved, inner = np.zeros(n, np.int64), np.zeros(n, np.int64), np.zeros(n, bool)
        leaves[starts[real]], saved[starts[real]] = all_leaves[real], all_saved[real]
        inner[starts[real & ~edge]] = True

        whole = np.flatnonzero(real & ~edge)  # none at the root
        if len(whole):
            above = np.flatnonzero(change[:, d - 2]) if d > 1 else np.zeros(1, np.int64)
            parent = np.searchsorted(above, starts[whole], "right") - 1
            parent_least = np.minimum.reduceat(conv, above)[parent]
            first, last = parent == 0, parent == len(above) - 1
            keys = [chains[0][d - 1] if f else chains[1][d - 1] if x else None for f, x in zip(first, last)]
            put(
                conv_id=least[whole].tolist(), depth=[d] * len(whole), parent_conv_id=[None if k else p for k, p in zip(keys, parent_least.tolist())],
                n_convs=members[whole].tolist(), n_children=children[whole].tolist(), n_leaves=all_leaves[whole].tolist(),
                saved_tokens=all_saved[whole].tolist(), block=[block] * len(whole), parent_key=keys,
                ends_sha256=[_sha(conv[s : s + e].tolist()) for s, e in zip(starts[whole].tolist(), ended[whole].tolist())],
            )
        for side, at in ((0, 0), (1, len(starts) - 1)):
            if not real[at]:
                continue
            again = side == 1 and at == 0  # on both paths: the part counts once, the path is whole on both sides
            ids = [] if again else conv[starts[at] : starts[at] + ended[at]].tolist()
            put(
                conv_id=[int(least[at])], depth=[d], n_convs=[0 if again else int(members[at])], n_children=[0 if again else int(whole_children[at])],
                n_leaves=[0 if again else int(all_leaves[at])], saved_tokens=[0 if again else int(all_saved[at])], block=[block], side=[side],
                key=[chains[side][d]], parent_key=[chains[side][d - 1] if d else None], words=[int(own_words[at])],
                pieces=[[{"first": ids[i], "ids": ",".join(map(str, ids[i : i + PIECE]))} for i in range(0, len(ids), PIECE)]],
            )
    return pa.RecordBatch.from_arrays([pa.array([x for part in rows[c] for x in part], k) for c, k in _KINDS.items()], names=list(_KINDS))


def _nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Sorted conversations (conv_id, path, words): the nodes of their blocks."""
    conv, paths, words, longest = [], [], [], 0
    for batch in batches:
        for c, p, w in zip(*(batch.column(k).to_pylist() for k in ("conv_id", "path", "words"))):
            size = max(longest, len(p) // _ID)
            if conv and (len(conv) == ROWS or (len(conv) + 1) * size > CELLS):
                yield _block(np.array(conv, np.int64), paths, words)
                conv, paths, words, size = [], [], [], len(p) // _ID
            conv.append(c)
            paths.append(p)
            words.append(w)
            longest = size
    if conv:
        yield _block(np.array(conv, np.int64), paths, words)


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pieces (key, first, ids) sorted by key and first id: the hash of each key's ids."""
    key, state, keys, out = None, None, [], []
    for batch in batches:
        for k, ids in zip(batch.column("key").to_pylist(), batch.column("ids").to_pylist()):
            if state is not None and k == key:
                state.update(b",")
            else:
                if state is not None:
                    keys.append(key)
                    out.append(state.hexdigest())
                key, state = k, hashlib.sha256()
            state.update(ids.encode())
        yield pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(out, pa.string())], names=["key", "ends"])
        keys, out = [], []
    if state is not None:
        yield pa.RecordBatch.from_arrays([pa.array([key], pa.binary()), pa.array([state.hexdigest()], pa.string())], names=["key", "ends"])


def trie(conversations: DataFrame) -> DataFrame:
    """A row per node of the trie of (conv_id, path, words), conv_id distinct: its smallest member, depth, parent's smallest member, members,
    children, childless nodes and saved words of its subtree, and the hash of the ids that end in it."""
    sequences = stored(conversations, "sequences")
    dealt = sequences.repartitionByRange("path", "conv_id").sortWithinPartitions("path", "conv_id")
    made = stored(dealt.mapInArrow(_nodes, _SHAPE), "nodes")
    whole, parts = made.where("key IS NULL"), made.where("key IS NOT NULL")
    at = F.struct("block", "side")
    summed = stored(
        parts.groupBy("key").agg(
            F.min("conv_id").alias("conv_id"), F.first("depth").alias("depth"), F.first("parent_key").alias("parent_key"), F.sum("n_convs").alias("n_convs"),
            F.sum("n_children").alias("whole_children"), F.sum("n_leaves").alias("leaves"), F.sum("saved_tokens").alias("saved"), F.first("words").alias("words"),
            F.min(F.when(F.col("n_convs") > 0, at)).alias("owner"),
        ),
        "boundary",
    )
    below = summed.where("parent_key IS NOT NULL").groupBy(F.col("parent_key").alias("key")).agg(F.count("*").alias("edges"))
    nodes = summed.join(below, "key", "left").withColumn("n_children", F.col("whole_children") + F.coalesce("edges", F.lit(0)))
    own = nodes.select("key", "owner", (F.col("n_children") == 0).cast("long").alias("is_leaf"), ((F.col("n_convs") - 1) * F.col("words")).alias("own_saved"))
    # a node's own values count on one of the paths that hold it, for it and all nodes above
    on_path = parts.select("key", "block", "side", "depth").join(own, "key").withColumn("mine", (F.struct("block", "side") == F.col("owner")).cast("long"))
    up = Window.partitionBy("block", "side").orderBy(F.desc("depth")).rowsBetween(Window.unboundedPreceding, 0)
    added = on_path.select("key", F.sum(F.col("mine") * F.col("is_leaf")).over(up).alias("more_leaves"), F.sum(F.col("mine") * F.col("own_saved")).over(up).alias("more_saved"))
    added = added.groupBy("key").agg(F.sum("more_leaves").alias("more_leaves"), F.sum("more_saved").alias("more_saved"))
    pieces = parts.select("key", F.inline("pieces")).repartition("key").sortWithinPartitions("key", "first")
    ends = pieces.mapInArrow(_ends, "key binary, ends string")
    named = summed.select(F.col("key").alias("parent_key"), F.col("conv_id").alias("parent"))
    boundary = (
        nodes.join(added, "key")
        .join(ends, "key", "left")
        .join(named, "parent_key", "left")
        .select(
            "conv_id", "depth", F.col("parent").alias("parent_conv_id"), "n_convs", "n_children", (F.col("leaves") + F.col("more_leaves")).alias("n_leaves"),
            (F.col("saved") + F.col("more_saved")).alias("saved_tokens"), F.coalesce("ends", F.lit(_sha([]))).alias("ends_sha256"),
        )
    )
    # whole nodes below a boundary node: looked up by block, so that no parent of many children is one key
    inside = parts.where("n_convs > 0").select("block", F.col("key").alias("parent_key")).join(named, "parent_key")
    hung = whole.where("parent_key IS NOT NULL").join(inside, ["block", "parent_key"]).withColumn("parent_conv_id", F.col("parent"))
    columns = boundary.columns
    return whole.where("parent_key IS NULL").select(*columns).unionByName(hung.select(*columns)).unionByName(boundary)
