"""Merkle manifest of a dataset: content-addressed records, and inclusion proofs found by descending from the root.

Method. Every row is a leaf. Per tree (one for each language) leaves are numbered by a range sort, and runs of ``arity`` nodes become
their hash until one is left, the subroot; the subroots are the leaves of one more tree, whose top is the root. The nodes are kept as
segments: ``digits`` levels below one node, as records that lead from a digest to its children's digests. Segments are addressed by
the digest of their top, so equal ones are stored once.

A request asks for a leaf by its rank. It descends from the root: in each segment the digits of the rank choose a child of the
node's record, the children that are not chosen are collected, and the segment's path, reversed, goes before what was collected above.
Requests share all segments but the last, so upper segments are descended once for each of their children, and each level of segments is
one join. In the last level requests stream past the records of their segment; none is held.

A tree never lands in one task, whatever share of the rows it has: numbers come from the range sort and offsets of its
partitions, and segments hold ``arity ** digits`` nodes at most.

Defined results: rows without doc_id come first in their tree; rows of one id are ordered by their digest, so repeated rows are leaves
beside each other. Null and empty values are different leaves. A tree of one row has the row's digest as its subroot, without siblings.
An empty table has no root and no rows. Columns beyond those of ``leaves_of`` are not part of a leaf.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass
from functools import partial

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from holdfast.llm.common import stored

ARITY = 2
DIGITS = 8  # levels of a segment, each of which takes one digit of a rank
FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
STEP = "struct<before: string, after: string>"
_STEP = pa.struct([("before", pa.string()), ("after", pa.string())])


def digest_of(values: list[Column]) -> Column:
    """SHA-256 over the values one after the other: ``-`` for null, else the number of UTF-8 bytes, a colon, the value."""
    texts = [v.cast("string") for v in values]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def leaves_of(docs: DataFrame) -> DataFrame:
    """(doc_id, lang, leaf, claim) of documents; the claim is the digest of a row that may have been tampered with: where 7 divides
    the CRC-32 of doc_id, one is added to n_chars."""
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 7 == 0, F.lit(False))
    tampered = F.when(hit, F.col("n_chars") + 1).otherwise(F.col("n_chars"))
    fields = [F.col(c) for c in FIELDS]
    return docs.select("doc_id", "lang", digest_of(fields).alias("leaf"), digest_of([tampered if c == "n_chars" else F.col(c) for c in FIELDS]).alias("claim"))


def numbered(rows: DataFrame, group: str | None, order: list[str], name: str) -> DataFrame:
    """``rows``, stored, with ``tree`` (number of the group in ascending order, null first), ``rank`` and ``n``: place of the row in its
    group and the group's size. Columns of these names are replaced. The numbers are fixed once the rows are written."""
    keys = [F.col(group).alias("g") if group else F.lit(None).cast("string").alias("g"), *[F.col(c).alias(f"k{i}") for i, c in enumerate(order)]]
    names = ["g", *[f"k{i}" for i in range(len(order))]]
    kept = [c for c in rows.columns if c not in ("tree", "rank", "n")]
    sorted_ = rows.select(*keys, F.struct(*kept).alias("row")).repartitionByRange(*names).sortWithinPartitions(*names)
    at = stored(sorted_.select("g", F.monotonically_increasing_id().alias("at"), "row"), name).withColumn("part", F.shiftright("at", 33))
    # a row for each partition and group: the partitions are ranges, so few groups are in two of them
    sizes = at.groupBy("part", "g").agg(F.count("*").alias("size"), F.min("at").alias("first"))
    group_, parts = Window.partitionBy("g"), Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    spans = sizes.select(
        F.col("part").alias("p"), F.col("g").alias("h"), "first",
        F.coalesce(F.sum("size").over(group_.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
        F.sum("size").over(group_).alias("n"), (F.row_number().over(group_.orderBy("part")) == 1).cast("int").alias("new"),
    )
    # groups are numbered likewise: how many begin in earlier partitions (a row for each), then inside the partition
    begun = spans.groupBy(F.col("p").alias("part")).agg(F.sum("new").alias("begun")).select(F.col("part").alias("q"), F.coalesce(F.sum("begun").over(parts), F.lit(0)).alias("trees"))
    spans = spans.join(begun, F.col("p") == F.col("q")).withColumn("tree", F.col("trees") + F.sum("new").over(Window.partitionBy("p").orderBy("first")) - 1)
    joined = at.join(spans, (F.col("part") == F.col("p")) & F.col("g").eqNullSafe(F.col("h")))
    return joined.select("row.*", "tree", (F.col("before") + F.col("at") - F.col("first")).alias("rank"), "n")


def _hashed(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def _segments(batches: Iterator[pa.RecordBatch], arity: int, digits: int) -> Iterator[pa.RecordBatch]:
    """Rows (tree, seg, rank, n, digest) sorted by tree and rank: a row per segment with its top and its records."""

    def top(nodes: list[str], whole: bool) -> tuple[str, list[str], list[list[str]]]:
        """``whole``: the tree has no node besides, so it ends where one is left."""
        parents, children = [], []
        for _ in range(digits):
            if whole and len(nodes) == 1:
                break
            runs = [nodes[i : i + arity] for i in range(0, len(nodes), arity)]
            nodes = [_hashed(r) for r in runs]
            parents += nodes
            children += runs
        return nodes[0], parents, children

    held: dict[tuple[int, int, int], list[str]] = {}

    def out(last: bool) -> pa.RecordBatch:
        rows = [(tree, seg, n, len(nodes), *top(nodes, n <= arity**digits)) for (tree, seg, n), nodes in list(held.items())[: None if last else -1]]
        for key in list(held)[: None if last else -1]:
            del held[key]
        columns = list(zip(*rows)) or [[]] * 7
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.string(), pa.list_(pa.string()), pa.list_(pa.list_(pa.string()))]
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "seg", "n", "width", "digest", "parents", "children"])

    for batch in batches:
        for tree, seg, n, digest in zip(*(batch.column(c).to_pylist() for c in ("tree", "seg", "n", "digest"))):
            held.setdefault((tree, seg, n), []).append(digest)
            if len(held) > 64:
                yield out(False)
    yield out(True)


_RECORDS = "tree long, seg long, n long, width int, digest string, parents array<string>, children array<array<string>>"


@dataclass(frozen=True)
class Manifest:
    """``leaves`` has tree, rank and n beside the columns it was built from; ``records`` has the segments of all trees by (kind, level,
    tree, seg), ``root`` one row with the digest of everything; ``heights`` and ``top`` count the levels of segments."""

    leaves: DataFrame
    records: DataFrame
    root: DataFrame
    heights: int
    top: int
    arity: int
    digits: int


def _grown(nodes: DataFrame, kind: str, arity: int, digits: int) -> tuple[list[DataFrame], DataFrame]:
    """Segments of all levels over (tree, rank, n, digest), and (tree, digest) of the tops."""
    segment = arity**digits
    levels: list[DataFrame] = []
    tops: DataFrame | None = None
    while True:
        dealt = nodes.withColumn("seg", F.floor(F.col("rank") / segment)).select("tree", "seg", "rank", "n", "digest")
        dealt = dealt.repartition("tree", "seg").sortWithinPartitions("tree", "seg", "rank")
        made = stored(dealt.mapInArrow(partial(_segments, arity=arity, digits=digits), _RECORDS), f"records-{kind}-{len(levels)}")
        levels.append(made.withColumns({"kind": F.lit(kind), "level": F.lit(len(levels))}))
        done = made.where(f"n <= {segment}").select("tree", "digest")
        tops = done if tops is None else tops.unionByName(done)
        rest = made.where(f"n > {segment}")
        if rest.isEmpty():
            return levels, tops
        nodes = rest.select("tree", F.col("seg").alias("rank"), F.ceil(F.col("n") / segment).alias("n"), "digest")


def build(leaves: DataFrame, digest: str = "leaf", group: str = "lang", order: str = "doc_id", arity: int = ARITY, digits: int = DIGITS) -> Manifest:
    """The manifest of rows with a digest; further columns stay beside the leaves."""
    ranked = numbered(leaves, group, [order, digest], "leaves")
    trees, subroots = _grown(ranked.select("tree", "rank", "n", F.col(digest).alias("digest")), "tree", arity, digits)
    # trees are numbered in the order of their groups already
    count = subroots.agg(F.count("*")).scalar()
    above, root = _grown(subroots.select(F.lit(0).cast("long").alias("tree"), F.col("tree").alias("rank"), count.alias("n"), "digest"), "root", arity, digits)
    records = trees + above
    whole = records[0]
    for level in records[1:]:
        whole = whole.unionByName(level)
    return Manifest(ranked, whole, root.select("digest"), len(trees), len(above), arity, digits)


def _height(n: str, segment: int) -> Column:
    """The highest level of segments of a tree of n leaves."""
    return F.expr(" + ".join(f"cast({n} > {segment**k}L AS int)" for k in range(1, 64) if segment**k < 1 << 63))


def _paths(row: dict, arity: int, digits: int) -> Iterator[tuple[int, str, list[dict]]]:
    """Descend from a segment's top to each node at its bottom: place, digest, and the steps from there to the root."""
    records = dict(zip(row["parents"], row["children"]))
    height = 0
    while arity**height < min(row["n"], arity**digits):
        height += 1
    for place in range(row["width"]):
        node, path = row["digest"], []
        for power in range(height - 1, -1, -1):
            children = records[node]
            chosen = place // arity**power % arity
            path.append({"before": "".join(children[:chosen]), "after": "".join(children[chosen + 1 :])})
            node = children[chosen]
        yield place, node, path[::-1] + row["above"]


def _lower(batches: Iterator[pa.RecordBatch], arity: int, digits: int) -> Iterator[pa.RecordBatch]:
    """Segments with the steps above them: a row for each node at their bottom."""
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.list_(_STEP)]
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1).to_pylist()[0]
            rows = [(row["tree"], row["seg"] * arity**digits + place, node, row["subroot"], steps) for place, node, steps in _paths(row, arity, digits)]
            yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names=["tree", "seg", "digest", "subroot", "above"])


def _answered(batches: Iterator[pa.RecordBatch], arity: int, digits: int) -> Iterator[pa.RecordBatch]:
    """Rows sorted by segment, the segment's own before its requests: a row per request."""
    paths: dict[int, list[dict]] = {}
    current, subroot = None, None
    for batch in batches:
        asked = [i for i, name in enumerate(batch.schema.names) if name not in _OWN]
        subroots, steps, rows = [], [], []
        for i, (tree, seg, own, rank) in enumerate(zip(*(batch.column(c).to_pylist() for c in ("tree", "seg", "own", "rank")))):
            if own:
                row = batch.slice(i, 1).to_pylist()[0]
                paths = {place: found for place, _, found in _paths(row, arity, digits)}
                current, subroot = (tree, seg), row["subroot"]
            elif current == (tree, seg) and rank % arity**digits in paths:
                rows.append(i)
                subroots.append(subroot)
                steps.append(paths[rank % arity**digits])
        kept = batch.take(pa.array(rows, pa.int64()))
        yield pa.RecordBatch.from_arrays(
            [*[kept.column(i) for i in asked], pa.array(subroots, pa.string()), pa.array(steps, pa.list_(_STEP))],
            names=[*[batch.schema.names[i] for i in asked], "subroot", "steps"],
        )


_OWN = ["tree", "seg", "own", "rank", "digest", "n", "width", "parents", "children", "subroot", "above"]


def prove(manifest: Manifest, requests: DataFrame) -> DataFrame:
    """``requests`` (tree, rank and any columns to keep, such as rows of ``manifest.leaves``) with ``subroot`` and the steps from the
    leaf to the root: what stands before and after a node in its run, which is '' where the node is alone. A rank that no leaf has
    gives no row."""
    shape_ = {"arity": manifest.arity, "digits": manifest.digits}
    segment = manifest.arity**manifest.digits
    records = manifest.records.select("kind", "level", "n", "width", "digest", "parents", "children")
    asked = manifest.root.select(F.lit(0).cast("long").alias("tree"), F.lit(0).cast("long").alias("seg"), "digest", F.lit(None).cast("string").alias("subroot"), F.expr(f"cast(array() AS array<{STEP}>)").alias("above"))
    shape = f"tree long, seg long, digest string, subroot string, above array<{STEP}>"

    def at(kind: str, level: int) -> DataFrame:
        return records.where((F.col("kind") == kind) & (F.col("level") == level)).drop("kind", "level").dropDuplicates(["digest"])

    for level in reversed(range(manifest.top)):
        asked = stored(asked.join(at("root", level), "digest").mapInArrow(partial(_lower, **shape_), shape), "asked")
    # the leaves of the last tree are the subroots: their place is the number of the tree
    sizes = manifest.records.where("kind = 'tree' AND level = 0 AND seg = 0").select("tree", F.col("n").alias("leaves"))
    waiting = asked.select(F.col("seg").alias("tree"), F.lit(0).cast("long").alias("seg"), "digest", F.col("digest").alias("subroot"), "above").join(sizes, "tree")
    waiting = stored(waiting.withColumn("height", _height("leaves", segment)).drop("leaves"), "asked")
    asked = waiting.where(f"height = {manifest.heights - 1}").drop("height")
    for level in reversed(range(1, manifest.heights)):
        lowered = stored(asked.join(at("tree", level), "digest").mapInArrow(partial(_lower, **shape_), shape), "asked")
        asked = lowered.unionByName(waiting.where(f"height = {level - 1}").drop("height"))
    last = asked.join(at("tree", 0), "digest").select("tree", "seg", F.lit(True).alias("own"), F.lit(None).cast("long").alias("rank"), "digest", "n", "width", "parents", "children", "subroot", "above")
    kept = [c for c in requests.columns if c not in ("tree", "rank", "n", "subroot", "steps")]
    named = {c: f"asked_{i}" for i, c in enumerate(kept)}
    rows = requests.select("tree", F.floor(F.col("rank") / segment).alias("seg"), F.lit(False).alias("own"), "rank", *[F.col(c).alias(n) for c, n in named.items()])
    both = last.unionByName(rows, allowMissingColumns=True).repartition("tree", "seg").sortWithinPartitions("tree", "seg", F.desc("own"))
    types = dict(requests.dtypes)
    shape = ", ".join([f"{n} {types[c]}" for c, n in named.items()] + ["subroot string", f"steps array<{STEP}>"])
    return both.mapInArrow(partial(_answered, **shape_), shape).withColumnsRenamed({n: c for c, n in named.items()})


def folded(leaf: Column, steps: Column) -> Column:
    """The root that follows from a leaf and the steps of its proof."""
    return F.aggregate(steps, leaf, lambda own, step: F.sha2(F.concat(step["before"], own, step["after"]), 256))


def siblings(steps: Column) -> Column:
    """The siblings' digests, level by level from the leaf to the root, left to right."""
    return F.array_join(F.transform(steps, lambda step: F.concat(step["before"], step["after"])), "")


def audit(docs: DataFrame) -> DataFrame:
    """Per document its leaf, subroot, root and proof, and whether the proof holds for the row as it is claimed to be."""
    manifest = build(stored(leaves_of(docs), "hashed"))
    proofs = prove(manifest, manifest.leaves.select("tree", "rank", "doc_id", "leaf", "claim"))
    found = proofs.withColumn("root", manifest.root.scalar())
    told = found.select("doc_id", "leaf", "subroot", "root", F.sha2(siblings(F.col("steps")), 256).alias("proof_sha256"), folded(F.col("claim"), F.col("steps")).alias("folded_root"))
    return told.withColumn("verified", F.col("folded_root") == F.col("root"))
