"""Token files of directly addressable codes.

Texts are encoded by a tokenizer file and stored in ascending order of doc_id, each document with an end id. Ids are split
into chunks of eight bits. Level 0 holds the low chunk of every id and a bitmap that says which ids go on; level 1 holds the
next chunk of those alone, and so on. A rank directory (set bits before every 512th) leads from an id's place in one level to
its place in the next, so any token is read from one byte per level, without decoding a block.

Files: ``segments`` is a Parquet table, so that Spark's commit protocol covers lost executors and any store works. A row is a
segment of whole documents: (part, seq, doc_ids, lengths, n_tokens, levels of (chunks, more, rank)). ``directory`` gives the
number of tokens before each segment. Parts are ranges of (doc_id, hash of the text), so equal ids are split as well.

Defined results: null or empty text is its end id alone. Null ids come first; rows that share an id follow in the order of
their text hashes. Other columns are ignored; an empty table gives an empty store.
"""

from __future__ import annotations

import unicodedata
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

SEGMENT = 1 << 20  # tokens after which a segment is closed
_CACHE = 600_000  # words, and parts of words, whose ids a worker remembers
_RANK = 512
_TEXT = 4_000_000  # bytes of text encoded at once
_MARKS = rb"""!"#$%&()*+,-./:;<=>?@[\]^_`{|}~"""  # ASCII punctuation but the apostrophe, which opens contractions


# --- codes ---------------------------------------------------------------------------------------------------------


def pack(ids: np.ndarray) -> list[tuple[bytes, bytes, bytes]]:
    """Levels (chunks, more, rank) of an array of unsigned ids."""
    levels, left = [], ids.astype(np.uint32)
    while len(left):
        goes_on = left > 255
        bits = np.packbits(goes_on, bitorder="little")
        blocks = np.add.reduceat(goes_on, np.arange(0, len(left), _RANK), dtype=np.uint32)
        rank = np.concatenate([[0], np.cumsum(blocks)[:-1]]).astype("<u4")
        levels.append(((left & 255).astype(np.uint8).tobytes(), bits.tobytes(), rank.tobytes()))
        left = left[goes_on] >> np.uint32(8)
    return levels


def unpack(levels: list) -> np.ndarray:
    """All ids of a segment."""
    out, places = np.empty(0, np.uint32), None
    for k, (chunks, more, _) in enumerate(levels):
        part = np.frombuffer(chunks, np.uint8).astype(np.uint32)
        if places is None:
            out = part
            places = np.arange(len(part))
        else:
            out[places] |= part << np.uint32(8 * k)
        bits = np.unpackbits(np.frombuffer(more, np.uint8), count=len(part), bitorder="little")
        places = places[bits == 1]
    return out


def token_in(levels: list, at: int) -> int:
    """The id at one place of a segment: one byte per level, the next place by the rank directory."""
    value = 0
    for k, (chunks, more, rank) in enumerate(levels):
        value |= chunks[at] << 8 * k
        if not more[at >> 3] >> (at & 7) & 1:
            return value
        first = at // _RANK * (_RANK // 8)
        before = int.from_bytes(more[first : (at >> 3) + 1], "little") & ((1 << (at - first * 8)) - 1)
        at = int.from_bytes(rank[4 * (at // _RANK) : 4 * (at // _RANK) + 4], "little") + before.bit_count()
    raise ValueError("the last level must end every id")


# --- encoding ------------------------------------------------------------------------------------------------------


def _letters(word: bytes) -> bool:
    """Whether a word has letters alone in the form that the tokenizer reads, composed and in lower case: there a capital may have become a
    letter and a mark, which is no letter and is cut together with punctuation behind it."""
    return word.isalpha() or unicodedata.normalize("NFC", word.decode()).lower().isalpha()


class WordEncoder:
    """Ids of whole texts from a tokenizer that treats white space as a mere separator: every different word goes through
    the library once while it is remembered. A worker keeps one encoder per file; the memory is bounded by ``_CACHE``."""

    held: dict[str, "WordEncoder"] = {}

    def __init__(self, path: str):
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.no_truncation()
        self.tokenizer.no_padding()
        self.known: dict[bytes, bytes] = {}  # ids of words
        self.stems: dict[bytes, bytes] = {b"": b""}  # ids of what the library has encoded
        vocabulary = self.tokenizer.get_vocab()
        self.ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self.ends[[i for t, i in vocabulary.items() if t.endswith("</w>")]] = True
        # for words of letters alone: the same model without the steps that change nothing in them
        self.lower = self.letters = self.tokenizer
        if _steps(self.tokenizer) == ["NFC", "Replace", "Lowercase", "Split", "ByteLevel"]:
            self.lower, self.letters = Tokenizer(self.tokenizer.model), Tokenizer(self.tokenizer.model)
            self.lower.pre_tokenizer = pre_tokenizers.WhitespaceSplit()
            self.letters.normalizer = normalizers.Sequence([normalizers.NFC(), normalizers.Lowercase()])
            spelled = pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters.pre_tokenizer = pre_tokenizers.Sequence([pre_tokenizers.WhitespaceSplit(), spelled])

    @classmethod
    def of(cls, path: str) -> "WordEncoder":
        if path not in cls.held:
            cls.held[path] = cls(path)
        return cls.held[path]

    def _library(self, words: list[bytes]) -> dict[bytes, bytes]:
        out = {}
        lower, letters, others = [], [], []
        for word in words:
            if word.isalpha() and word.islower():
                lower.append(word)
            else:
                (letters if _letters(word) else others).append(word)
        for tokenizer, kind in ((self.lower, lower), (self.letters, letters)):
            for lo in range(0, len(kind), 4096):  # a word of letters alone ends where a token says so
                part = kind[lo : lo + 4096]
                found = tokenizer.encode_batch_fast([b" ".join(part).decode()], add_special_tokens=False)
                ids = np.array(found[0].ids, "<u4")
                ends = np.flatnonzero(self.ends[ids]) + 1
                if len(ends) != len(part):
                    others += part
                    continue
                data, ends = ids.tobytes(), (ends * 4).tolist()
                out.update(zip(part, (data[a:b] for a, b in zip([0, *ends], ends))))
        for lo in range(0, len(others), 4096):
            part = others[lo : lo + 4096]
            found = self.tokenizer.encode_batch_fast([w.decode() for w in part], add_special_tokens=False)
            out.update((w, np.array(e.ids, "<u4").tobytes()) for w, e in zip(part, found))
        return out

    @staticmethod
    def _stem(word: bytes) -> tuple[bytes, bytes]:
        """A word of letters, ASCII ones in lower case, apart from the marks behind it; other words as they are."""
        if word.isalpha():
            return word.lower(), b""
        stem = word.rstrip(_MARKS)
        if len(stem) < len(word) and _letters(stem):
            return stem.lower(), word[len(stem) :]  # on bytes only ASCII letters change
        return word, b""

    def _learn(self, words: list[bytes]) -> None:
        """Have the ids of different ``words`` in ``known``."""
        known = self.known
        fresh = [w for w in words if w not in known]
        if not fresh:
            return
        if len(known) + len(fresh) > _CACHE:
            known = self.known = {w: known[w] for w in words if w in known}
        stems = [self._stem(w) for w in fresh]
        parts = {part for pair in stems for part in pair}
        ids = self.stems
        new = [part for part in parts if part not in ids]
        if len(ids) + len(new) > _CACHE:
            ids = self.stems = {b"": b""} | {part: ids[part] for part in parts if part in ids}
        ids.update(self._library(new))
        known.update((w, ids[a] + ids[b] if b else ids[a]) for w, (a, b) in zip(fresh, stems))

    def encode(self, texts: list[list[bytes]]) -> list[np.ndarray]:
        """``texts`` as lists of words."""
        self._learn(list(set().union(*texts)))
        return [np.frombuffer(b"".join(map(self.known.__getitem__, words)), "<u4") for words in texts]

    def encode_column(self, texts: pa.Array) -> list[np.ndarray]:
        """``texts`` as a column of strings without nulls: split and counted by Arrow, so that a word is looked up once however often it occurs."""
        lists = pc.ascii_split_whitespace(texts)
        coded = lists.flatten().dictionary_encode()
        words = _bytes_of(coded.dictionary)
        self._learn(words)
        found = list(map(self.known.__getitem__, words))
        table = np.frombuffer(b"".join(found), "<u4")
        sizes = np.fromiter(map(len, found), np.int64, len(found)) // 4
        at = coded.indices.to_numpy()
        length = sizes[at]
        ends = np.concatenate([[0], np.cumsum(length)])
        first = (np.cumsum(sizes) - sizes)[at] - ends[:-1]  # what leads from a place in the texts to a place in the table
        ids = table[np.repeat(first, length) + np.arange(ends[-1])]
        cuts = ends[lists.offsets.to_numpy() - lists.offsets[0].as_py()].tolist()
        return [ids[a:b] for a, b in zip(cuts, cuts[1:])]


def _steps(tokenizer) -> list[str]:
    """What a tokenizer does before its model, by name; empty if it is not two sequences."""
    try:
        return [type(step).__name__ for steps in (tokenizer.normalizer, tokenizer.pre_tokenizer) for step in steps]
    except TypeError:
        return []


def _bytes_of(column: pa.StringArray) -> list[bytes]:
    """The bytes of a column without nulls; slices of its buffer, since Arrow's own lists take longer."""
    _, offsets, data = column.buffers()
    if not len(column):
        return []
    cuts = np.frombuffer(offsets, np.int32)[column.offset : column.offset + len(column) + 1].tolist()
    held = data.to_pybytes() if data is not None else b""
    return [held[a:b] for a, b in zip(cuts, cuts[1:])]


_SEGMENT_DDL = (
    "part int, seq int, doc_ids array<long>, lengths array<long>, n_tokens long, "
    "levels array<struct<chunks: binary, more: binary, rank: binary>>"
)
_LEVEL = pa.struct([("chunks", pa.binary()), ("more", pa.binary()), ("rank", pa.binary())])
_SEGMENT = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("doc_ids", pa.list_(pa.int64())), ("lengths", pa.list_(pa.int64())), ("n_tokens", pa.int64()), ("levels", pa.list_(_LEVEL))]
)


def _segments(tokenizer: str, end_id: int):
    end = np.array([end_id], "<u4")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, part = WordEncoder.of(tokenizer), TaskContext.get().partitionId()
        ids, parts, size, seq = [], [], 0, 0

        def close() -> pa.RecordBatch:
            levels = [dict(zip(("chunks", "more", "rank"), level)) for level in pack(np.concatenate(parts))]
            row = [[part], [seq], [ids], [[len(p) for p in parts]], [size], [levels]]
            return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(row, _SEGMENT)], schema=_SEGMENT)

        for batch in batches:
            texts, docs = batch.column(1).cast(pa.string()), batch.column(0).to_pylist()
            size_to = np.cumsum(pc.binary_length(texts).to_numpy(), dtype=np.int64)  # write_tokens leaves no null
            lo = 0
            while lo < len(texts):
                before = size_to[lo - 1] if lo else 0
                hi = max(lo + 1, int(np.searchsorted(size_to, before + _TEXT, side="right")))
                for doc, tokens in zip(docs[lo:hi], encoder.encode_column(texts.slice(lo, hi - lo))):
                    ids.append(doc)
                    parts.append(np.concatenate([tokens, end]))
                    size += len(parts[-1])
                    if size >= SEGMENT:
                        yield close()
                        ids, parts, size, seq = [], [], 0, seq + 1
                lo = hi
        if ids:
            yield close()

    return run


def write_tokens(docs: DataFrame, path: str, tokenizer: str, end_id: int) -> "TokenStore":
    """Encode the texts of ``docs`` (doc_id, text) into a new store at ``path``; ``tokenizer`` is a file that every
    executor has, of a tokenizer that drops white space and lower-cases (see ``WordEncoder``)."""
    spark = docs.sparkSession
    texts = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    keyed = texts.withColumn("th", F.xxhash64("text"))
    in_order = keyed.repartitionByRange("doc_id", "th").sortWithinPartitions("doc_id", "th").select("doc_id", "text")
    in_order.mapInArrow(_segments(tokenizer, end_id), _SEGMENT_DDL).write.parquet(f"{path}/segments")
    sizes = spark.read.parquet(f"{path}/segments").select("part", "seq", "n_tokens")
    # one row per part here, so that the only ordering over everything sees no more rows than there were tasks
    parts = sizes.groupBy("part").agg(F.sum("n_tokens").alias("size"))
    before = F.sum("size").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1))
    parts = parts.select("part", F.coalesce(before, F.lit(0)).alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("part").orderBy("seq").rowsBetween(Window.unboundedPreceding, -1))
    starts = sizes.withColumn("inside", F.coalesce(inside, F.lit(0))).join(parts, "part")
    starts.select("part", "seq", "n_tokens", (F.col("before") + F.col("inside")).alias("start")).write.parquet(f"{path}/directory")
    return TokenStore(spark, path)


_DOC = pa.schema(
    [("part", pa.int32()), ("seq", pa.int32()), ("doc_id", pa.int64()), ("inside", pa.int64()), ("n_tokens", pa.int64()), ("ids_crc32", pa.int64())]
)


def _levels_of(row: list) -> list[tuple[bytes, bytes, bytes]]:
    return [(x["chunks"], x["more"], x["rank"]) for x in row]


def _read_docs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for k in range(batch.num_rows):
            part, seq, docs, lengths, levels = (batch.column(c)[k].as_py() for c in ("part", "seq", "doc_ids", "lengths", "levels"))
            ids = unpack(_levels_of(levels)).astype("<u4")
            ends = np.cumsum(lengths)
            starts = ends - lengths
            sums = [zlib.crc32(ids[a:b].tobytes()) for a, b in zip(starts, ends)]
            columns = [[part] * len(docs), [seq] * len(docs), docs, starts, lengths, sums]
            yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(columns, _DOC)], schema=_DOC)


class TokenStore:
    """Reader of the files that ``write_tokens`` leaves."""

    def __init__(self, spark: SparkSession, path: str):
        self.segments = spark.read.parquet(f"{path}/segments")
        self.directory = spark.read.parquet(f"{path}/directory")

    def documents(self) -> DataFrame:
        """(doc_id, start, n_tokens, ids_crc32) per document, from the stored codes."""
        docs = self.segments.mapInArrow(_read_docs, "part int, seq int, doc_id long, inside long, n_tokens long, ids_crc32 long")
        starts = self.directory.select("part", "seq", "start")
        return docs.join(starts, ["part", "seq"]).select("doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")

    def token(self, at: int) -> int:
        """The id at place ``at`` of the whole store: one directory row, one segment row, one byte per level."""
        found = self.directory.where((F.col("start") <= at) & (F.col("start") + F.col("n_tokens") > at)).first()
        if found is None:
            raise IndexError(at)
        row = self.segments.where((F.col("part") == found.part) & (F.col("seq") == found.seq)).select("levels").first()
        return token_in(_levels_of(row.levels), at - found.start)
