"""Removal of repeated byte strings by external induced sorting of suffixes.

Every byte that a string of ``window`` bytes covers is removed if the same string also starts anywhere else.

Method. Suffixes are sorted in two stages, as in induced sorting: first a sample of them, then all others from
the order of the sample.

* Sample: in every window the position whose ``gram`` bytes hash lowest. Equal windows sample the same place, so
  a repeated window always holds a sampled suffix that occurs at least twice. Samples that occur once are settled.
* Equal surroundings (all bytes that a window around the sample can reach) are counted first, in partial sums: if
  they occur twice, every window in them is repeated. This is what very common passages and copies come down to.
* The other surroundings of a sample are sorted by the suffix at the sample. The queue that carries these tuples is
  Spark's own sort, which spills sorted runs to disk and merges them, so a shard may be far larger than memory.
  Common prefixes of neighbours are computed as the tuples leave the queue in order.
* Induction: the order of the suffixes one byte further left follows from the order just found by a stable
  distribution on that byte; the common prefix of new neighbours is one more than the least value between them.
  This is repeated, each round from the last, until every window around the samples has been reached. A window is
  repeated if its suffix shares ``window`` bytes with a neighbour; suffixes without a neighbour that shares the
  bytes left of the sample drop out.
* Samples with more than ``GROUP`` different surroundings don't meet in one task. Their windows are settled in bands of
  neighbouring starts by counts with partial sums: surroundings that agree on all bytes of a band's windows repeat in the
  whole band, those that share not even the bytes which all its windows have in common don't repeat in it, and the rest
  goes on with narrower bands, down to single windows. Bytes are compared by 128-bit hashes here.

Defined results: null text is empty; an empty table gives an empty one. Rows that repeat in id and text are
separate documents, so they are copies of each other. Other columns are ignored (``remove_repeats`` keeps them).
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from holdfast.llm.common import as_bytes, lean, stored

WINDOW = 400
GROUP = 10_000  # different surroundings of one sample that are sorted in one task
_PIECE = 1 << 20  # window starts handled at once
_BLOCK = 10_000  # surroundings in memory at once, besides the group that is being read
_ODD = np.uint64(0x9E3779B97F4A7C15)
_UNDO = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))


def _gram(window: int) -> int:
    return max(1, window // 4)


def _powers(base: np.uint64, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _slide(values: np.ndarray, width: int, pick) -> np.ndarray:
    """``pick`` (minimum or maximum) over every run of ``width`` values."""
    span = 1
    while span * 2 <= width:
        values = pick(values[:-span], values[span:])
        span *= 2
    rest = width - span
    return pick(values[: len(values) - rest], values[rest:]) if rest else values


def samples(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, window: int, powers: tuple) -> tuple[np.ndarray, np.ndarray]:
    """Sampled positions in ``data`` (several texts one after the other, given by starts and ends) and their hashes."""
    gram = _gram(window)
    n = len(data)
    if n < window:
        return np.empty(0, np.int64), np.empty(0, np.uint64)
    up, down = powers
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:n], out=total[1:])
    value = (total[gram:] - total[:-gram]) * down[: n - gram + 1]
    value ^= value >> np.uint64(29)  # spread, so that the lowest is as good as random
    value *= np.uint64(0xBF58476D1CE4E5B9)
    value ^= value >> np.uint64(32)
    np.maximum(value, np.uint64(1), out=value)
    span = window - gram + 1
    least = _slide(value, span, np.minimum)  # by window start
    fits = np.zeros(n + 1, dtype=np.int32)
    long = ends - starts >= window
    np.add.at(fits, starts[long], 1)
    np.add.at(fits, ends[long] - window + 1, -1)
    least[np.cumsum(fits)[: len(least)] == 0] = 0  # windows that would leave their text
    pad = np.zeros(span - 1, dtype=np.uint64)
    most = _slide(np.concatenate([pad, least, pad]), span, np.maximum)  # by position of the gram
    at = np.flatnonzero(most == value)
    return at, value[at]


_SEEN = pa.schema(
    [("h", pa.int64()), ("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("ctx", pa.int64()), ("ctx2", pa.int64()), ("left", pa.int32()), ("right", pa.int32())]
)
_SEEN_DDL = "h long, doc_id long, th long, pos int, ctx long, ctx2 long, left int, right int"


def _occurrences(window: int):
    gram = _gram(window)
    reach = window - gram  # bytes left of a sample that a window around it can hold

    def texts_in_pieces(texts: list[bytes]) -> Iterator[list[tuple[int, int, bytes]]]:
        """Lists of (row, offset, bytes); a long text comes in pieces that overlap by a window less one."""
        held, size = [], 0
        for row, text in enumerate(texts):
            for at in range(0, max(1, len(text) - window + 1), _PIECE):
                piece = text if len(text) <= _PIECE else text[at : at + _PIECE + window - 1]
                if len(piece) >= window:
                    held.append((row, at, piece))
                    size += len(piece)
                if size >= _PIECE:
                    yield held
                    held, size = [], 0
        if held:
            yield held

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        powers = None
        for batch in batches:
            ids, marks, texts = batch.column(0), batch.column(1), as_bytes(batch.column(2))
            before = (-1, -1)
            for pieces in texts_in_pieces(texts):
                lengths = np.array([len(p) for _, _, p in pieces])
                ends = np.cumsum(lengths)
                starts = ends - lengths
                data = np.frombuffer(b"".join(p for _, _, p in pieces), dtype=np.uint8)
                if powers is None or len(powers[0]) < len(data):
                    powers = _powers(_ODD, len(data)), _powers(_UNDO, len(data))
                at, hashes = samples(data, starts, ends, window, powers)
                which = np.searchsorted(ends, at, side="right")
                rows, pos, ctx, ctx2, left, right, keep = [], [], [], [], [], [], []
                for k, (p, w) in enumerate(zip((at - starts[which]).tolist(), which.tolist())):
                    row, offset, _ = pieces[w]
                    p += offset
                    if (row, p) <= before:  # in the overlap of two pieces
                        continue
                    before = (row, p)
                    text = texts[row]
                    a, b = max(0, p - reach), min(len(text), p + window)
                    digest = xxhash.xxh3_128_intdigest(text[a:b], p - a)
                    rows.append(row)
                    pos.append(p)
                    ctx.append(digest & (2**64 - 1))
                    ctx2.append(digest >> 64)
                    left.append(p - a)
                    right.append(b - p)
                    keep.append(k)
                if rows:
                    take = pa.array(rows, pa.int32())
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array(hashes[keep].view(np.int64)),
                            ids.take(take),
                            marks.take(take),
                            pa.array(pos, pa.int32()),
                            pa.array(np.array(ctx, dtype=np.uint64).view(np.int64)),
                            pa.array(np.array(ctx2, dtype=np.uint64).view(np.int64)),
                            pa.array(left, pa.int32()),
                            pa.array(right, pa.int32()),
                        ],
                        schema=_SEEN,
                    )

    return found


# --- induction ---------------------------------------------------------------------------------------------------

_TUPLE_DDL = "g long, alone boolean, doc_id long, th long, pos int, suffix binary, before binary, many boolean"
_TUPLE = pa.schema(
    [("g", pa.int64()), ("alone", pa.bool_()), ("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("suffix", pa.binary()), ("before", pa.binary())]
)
_SPAN = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("end", pa.int32())])
#: Spans, and the tuples that are left to another step.
_OUT = pa.schema([*_SPAN, *(f for f in _TUPLE if f.name not in _SPAN.names)])
_OUT_DDL = "doc_id long, th long, start int, end int, g long, alone boolean, pos int, suffix binary, before binary"


def _cut(window: int):
    """Rows (docs joined with their list of surroundings): one tuple per surroundings with its bytes. ``before`` is reversed."""
    reach = window - _gram(window)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = as_bytes(batch.column(2))
            out: list[list] = [[] for _ in range(8)]
            for doc, th, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), texts, batch.column(3).to_pylist()):
                for g in wanted:
                    p = g["pos"]
                    a = max(0, p - reach)
                    for column, x in zip(out, (g["h"], g["alone"], doc, th, p, text[p : p + window], text[a:p][::-1], g["many"])):
                        column.append(x)
            if out[0]:
                kinds = [*_TUPLE.types, pa.bool_()]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(out, kinds)], names=[*_TUPLE.names, "many"])

    return cut


def _padded(strings: list[bytes], width: int) -> np.ndarray:
    """Matrix of the strings' bytes plus one; zero beyond a string's end."""
    out = np.zeros((len(strings), width), dtype=np.uint16)
    lengths = np.fromiter(map(len, strings), dtype=np.int64, count=len(strings))
    filled = np.arange(width) < lengths[:, None]
    out[filled] = np.frombuffer(b"".join(strings), dtype=np.uint8)
    out[filled] += 1
    return out


class _LeastBetween:
    """Minimum of any stretch of an array in constant time."""

    def __init__(self, values: np.ndarray):
        self.levels = [values]
        while 2 ** len(self.levels) <= len(values):
            last, half = self.levels[-1], 2 ** (len(self.levels) - 1)
            self.levels.append(np.minimum(last[:-half], last[half:]))

    def __call__(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """Over first..last, both included."""
        level = np.frexp((last - first + 1).astype(float))[1] - 1
        out = np.empty(len(first), dtype=self.levels[0].dtype)
        for k in np.unique(level):
            m = level == k
            out[m] = np.minimum(self.levels[k][first[m]], self.levels[k][last[m] - 2**k + 1])
        return out


def induced(groups: np.ndarray, suffixes: list[bytes], before: list[bytes], window: int) -> tuple[np.ndarray, np.ndarray]:
    """Repeated windows among tuples sorted by (group, suffix): tuple numbers and how many bytes left of the sample
    the window starts."""
    n, reach = len(groups), window - _gram(window)
    text = _padded(suffixes, window)
    same = np.empty(n, dtype=np.int32)
    same[:1] = -1
    for lo in range(1, n, 8192):  # common prefixes of neighbours in the queue
        a, b = text[lo - 1 : min(n, lo + 8192) - 1], text[lo : lo + 8192]
        differ = (a != b) | (b == 0)
        same[lo : lo + len(b)] = np.where(differ.any(axis=1), differ.argmax(axis=1), window)
    same[1:][groups[1:] != groups[:-1]] = -1
    length = np.fromiter(map(len, suffixes), dtype=np.int32, count=n)
    least = _LeastBetween(same)
    left = _padded(before, reach)
    order, kind = np.arange(n), np.unique(groups, return_inverse=True)[1].astype(np.int64)
    tuples, offsets = [], []
    for o in range(reach + 1):
        if o:  # induce the suffixes one byte further left
            byte = left[order, o - 1]
            order, kind, byte = order[byte > 0], kind[byte > 0], byte[byte > 0]
            key = kind * 257 + byte
            turn = np.argsort(key, kind="stable")
            order, key = order[turn], key[turn]
            kind = np.cumsum(np.concatenate([[0], key[1:] != key[:-1]])) if len(key) else key
        if len(order) < 2:
            break
        beside = kind[1:] == kind[:-1]
        common = np.full(len(order) - 1, -1, dtype=np.int32)
        common[beside] = least(order[:-1][beside] + 1, order[1:][beside])
        linked = common >= window - o
        whole = np.concatenate([[False], linked]) | np.concatenate([linked, [False]])
        whole &= length[order] >= window - o
        if whole.any():
            tuples.append(order[whole])
            offsets.append(np.full(len(tuples[-1]), o))
        alive = np.concatenate([[False], beside]) | np.concatenate([beside, [False]])
        order, kind = order[alive], kind[alive]
    none = [np.empty(0, np.int64)]
    return np.concatenate(tuples or none), np.concatenate(offsets or none)


def _runs(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last of each run of consecutive integers in a sorted array."""
    cuts = np.flatnonzero(np.diff(values) != 1)
    return values[np.concatenate([[0], cuts + 1])], values[np.append(cuts, len(values) - 1)]


def _induce(window: int):
    """Tuples in queue order: spans to remove. Tuples of samples with very many surroundings pass through."""

    def block(cols: list[list]) -> pa.RecordBatch | None:
        g, alone, doc, th, pos, suffix, before = cols
        rows, offsets = induced(np.array(g), suffix, before, window)
        turn = np.lexsort((offsets, rows))
        by_row, by_offset = rows[turn], offsets[turn]
        cuts = np.flatnonzero(np.diff(by_row, prepend=-1))
        out: list[list] = [[] for _ in _SPAN]
        for a, b in zip(cuts, np.append(cuts[1:], len(by_row))):
            i = int(by_row[a])
            if alone[i]:  # the bytes of surroundings that occur twice are removed already
                for lo, hi in zip(*_runs(by_offset[a:b])):
                    for column, x in zip(out, (doc[i], th[i], pos[i] - int(hi), pos[i] - int(lo) + window)):
                        column.append(x)
        return filled(dict(zip(_SPAN.names, out)), len(out[0])) if out[0] else None

    def filled(columns: dict, n: int) -> pa.RecordBatch:
        arrays = [columns[f.name] if f.name in columns else pa.nulls(n, f.type) for f in _OUT]
        return pa.RecordBatch.from_arrays([x if isinstance(x, pa.Array) else pa.array(x, f.type) for x, f in zip(arrays, _OUT)], schema=_OUT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[] for _ in range(7)]
        last = None
        for batch in batches:
            passing = batch.filter(batch.column("many"))
            if passing.num_rows:
                yield filled({n: passing.column(n) for n in _TUPLE.names}, passing.num_rows)
                batch = batch.filter(pc.invert(batch.column("many")))
            columns = [batch.column(n).to_pylist() for n in _TUPLE.names]
            at = 0
            for k, key in enumerate(columns[0]):
                if key != last:
                    for mine, new in zip(held, columns):
                        mine.extend(new[at:k])
                    at = k
                    if len(held[0]) >= _BLOCK:
                        if (out := block(held)) is not None:
                            yield out
                        held = [[] for _ in range(7)]
                    last = key
            for mine, new in zip(held, columns):
                mine.extend(new[at:])
        if held[0] and (out := block(held)) is not None:
            yield out

    return run


# --- samples with very many surroundings -------------------------------------------------------------------------

_BAND = pa.schema(
    [("doc_id", pa.int64()), ("th", pa.int64()), ("pos", pa.int32()), ("lo", pa.int32()), ("hi", pa.int32()), ("outer", pa.binary()), ("inner", pa.binary())]
)
_BAND_DDL = "doc_id long, th long, pos int, lo int, hi int, outer binary, inner binary"


def _band_keys(window: int, width: int):
    """Tuples with their ``bands`` (lo): per band of window starts lo..lo + width - 1 bytes left of the sample the hash of all bytes that
    its windows have (``outer``) and of the bytes that each of them has (``inner``)."""
    reach = window - _gram(window)

    def keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in _BAND]
            for g, _, doc, th, pos, suffix, before, bands in zip(*(c.to_pylist() for c in batch.columns)):
                for lo in bands:
                    hi = min(lo + width, reach + 1)
                    if len(before) < lo or len(suffix) < window - hi + 1:
                        continue  # no window of the band is in the text
                    seed = (g * 1_000_003 + lo * 4099 + hi) % 2**64
                    inner = xxhash.xxh3_128_digest(before[:lo][::-1] + suffix[: window - hi + 1], seed)
                    if len(before) >= hi - 1 and len(suffix) >= window - lo:
                        outer = xxhash.xxh3_128_digest(before[: hi - 1][::-1] + suffix[: window - lo], seed)
                    else:  # cut off by the text's ends, so like no other
                        outer = xxhash.xxh3_128_digest(f"{doc} {th} {pos} {lo} {hi}".encode(), 1)
                    for column, x in zip(out, (doc, th, pos, lo, hi, outer, inner)):
                        column.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(out, _BAND)], schema=_BAND)

    return keys


def _spans_by_bands(tuples: DataFrame, window: int) -> DataFrame:
    """Spans of repeated windows around samples with any number of surroundings (``tuples`` as the queue has them)."""
    reach = window - _gram(window)
    widths = [1]
    while widths[-1] * 8 <= reach:
        widths.append(widths[-1] * 8)
    spans = None
    bands = tuples.withColumn("bands", F.array(*[F.lit(lo) for lo in range(0, reach + 1, widths[-1])]))
    for width in reversed(widths):
        keyed = stored(bands.mapInArrow(lean(_band_keys(window, width)), _BAND_DDL), "bands")
        classes = stored(
            keyed.groupBy("outer", "inner", "lo").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "pos")).alias("rep")), "classes"
        )
        repeated = keyed.join(classes.where("n > 1").select("outer"), "outer", "left_semi")
        found = repeated.select("doc_id", "th", (F.col("pos") - F.col("hi") + 1).alias("start"), (F.col("pos") - F.col("lo") + window).alias("end"))
        spans = found if spans is None else spans.unionByName(found)
        if width > 1:
            shared = classes.groupBy("inner").agg(F.count("*").alias("m")).where("m > 1").select("inner")
            children = F.sequence(F.col("lo"), F.least(F.col("lo") + width - 1, F.lit(reach)), F.lit(width // 8))
            waiting = classes.join(shared, "inner", "left_semi").select("rep.*", F.explode(children).alias("lo"))
            waiting = waiting.groupBy("doc_id", "th", "pos").agg(F.collect_list("lo").alias("bands"))
            t, w = tuples.alias("t"), waiting.alias("w")
            same = F.col("t.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("t.th") == F.col("w.th")) & (F.col("t.pos") == F.col("w.pos"))
            bands = t.join(w, same).select("t.*", "w.bands")
    return spans


def repeated_spans(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, th, spans) for the texts of ``docs`` (doc_id, th, text) with repeated strings; ``th`` hashes the text, so that
    the two name a text even if ids repeat. Spans are [start, end) in bytes and may overlap."""
    seen = stored(docs.select("doc_id", "th", "text").mapInArrow(lean(_occurrences(window)), _SEEN_DDL), "occurrences")
    texts = seen.groupBy("h", "ctx", "ctx2").agg(F.count("*").alias("n"), F.min(F.struct("doc_id", "th", "pos")).alias("rep"))
    kinds = texts.groupBy("h").agg(F.count("*").alias("m"))
    spans = (
        seen.join(texts.where("n > 1").select("h", "ctx", "ctx2"), ["h", "ctx", "ctx2"], "left_semi")
        .where(F.col("left") + F.col("right") >= window)
        .select("doc_id", "th", (F.col("pos") - F.col("left")).alias("start"), (F.col("pos") + F.col("right")).alias("end"))
    )
    wanted = stored(
        texts.join(kinds.where("m > 1"), "h").select(
            "h", (F.col("m") > group).alias("many"), (F.col("n") == 1).alias("alone"), "rep.doc_id", "rep.th", "rep.pos"
        ),
        "surroundings",
    )

    per_doc = wanted.groupBy("doc_id", "th").agg(F.collect_list(F.struct("h", "alone", "pos", "many")).alias("wanted"))
    same = F.col("d.doc_id").eqNullSafe(F.col("w.doc_id")) & (F.col("d.th") == F.col("w.th"))
    tuples = docs.alias("d").join(per_doc.alias("w"), same).select("d.doc_id", "d.th", "d.text", "w.wanted").mapInArrow(lean(_cut(window)), _TUPLE_DDL)
    # tuples that only pass through are spread evenly
    salt = F.when(F.col("many"), F.pmod(F.xxhash64("doc_id", "th", "pos"), F.lit(4096)) + 1).otherwise(0)
    queue = tuples.withColumn("salt", salt).repartition("g", "salt").sortWithinPartitions("g", "salt", "suffix", "pos").drop("salt")
    found = stored(queue.mapInArrow(lean(_induce(window)), _OUT_DDL), "induced")
    spans = spans.unionByName(found.where("suffix IS NULL").select("doc_id", "th", "start", "end"))
    if not wanted.where("many").isEmpty():
        many = found.where("suffix IS NOT NULL").select(*_TUPLE.names)
        spans = spans.unionByName(_spans_by_bands(many, window))
    return spans.distinct().groupBy("doc_id", "th").agg(F.collect_list(F.struct("start", "end")).alias("spans"))


def kept_parts(text: bytes, spans: list | None) -> tuple[list[bytes], int, int]:
    """What is left of a text, how many bytes go and in how many runs."""
    parts, at, gone, runs = [], 0, 0, 0
    for span in sorted((s["start"], s["end"]) for s in spans or ()):
        if span[0] > at or not runs:
            parts.append(text[at : span[0]])
            runs += 1
            at = max(at, span[0])
        gone += max(0, span[1] - at)
        at = max(at, span[1])
    parts.append(text[at:])
    return parts, gone, runs


def _with_spans(docs: DataFrame, window: int, group: int) -> DataFrame:
    """``row`` (all columns) and the spans to remove, per row of ``docs``."""
    text = F.coalesce(F.col("row.text"), F.lit(""))
    rows = docs.select(F.struct("*").alias("row"))
    named = rows.select("row", F.col("row.doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("th"))
    spans = repeated_spans(named.select("doc_id", "th", text.alias("text")), window, group)
    same = F.col("d.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("d.th") == F.col("s.th"))
    return named.alias("d").join(spans.alias("s"), same, "left").select("d.row", "s.spans")


_DIGEST = pa.schema(
    [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())]
)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = as_bytes(batch.column(1))
        sizes, gone, runs, sums = [], [], [], []
        for text, spans in zip(texts, batch.column(2).to_pylist()):
            parts, g, r = kept_parts(text, spans)
            digest = hashlib.sha256()
            for part in parts:
                digest.update(part)
            sizes.append(len(text))
            gone.append(g)
            runs.append(r)
            sums.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(sizes), pa.array(gone), pa.array(runs), pa.array(sums)], schema=_DIGEST)


def removal_report(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256) per row of ``docs``."""
    found = _with_spans(docs.select("doc_id", F.col("text").cast("string").alias("text")), window, group)
    return found.select(F.col("row.doc_id").cast("long").alias("doc_id"), "row.text", "spans").mapInArrow(
        _digests, "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    )


@F.arrow_udf(T.StringType())
def _kept_text(text: pa.Array, spans: pa.Array) -> pa.Array:
    """A character of which a part goes goes as a whole."""
    out = [b"".join(kept_parts(t, s)[0]).decode("utf-8", "ignore") for t, s in zip(as_bytes(text), spans.to_pylist())]
    return pa.array(out, pa.string())


def remove_repeats(docs: DataFrame, window: int = WINDOW, group: int = GROUP) -> DataFrame:
    """All rows and columns of ``docs``; texts with repeats are cut (characters cut in half go), other texts stay as they
    are (null too). Where there is a column n_chars it counts the characters that are left."""
    found = _with_spans(docs, window, group)
    cut = F.when(F.col("spans").isNull(), F.col("row.text")).otherwise(_kept_text(F.col("row.text"), F.col("spans")))
    ready = found.select("row", cut.alias("cut"), F.col("spans").isNotNull().alias("changed"))
    columns = []
    for name, kind in docs.dtypes:
        mine = F.col(f"row.`{name}`")
        if name == "text":
            mine = F.col("cut")
        elif name == "n_chars":
            mine = F.when(F.col("changed"), F.char_length("cut").cast(kind)).otherwise(mine)
        columns.append(mine.alias(name))
    return ready.select(*columns)
