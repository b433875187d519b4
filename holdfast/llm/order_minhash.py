"""Order MinHash: document fingerprints that follow the order of a text, in DataFrame functions only.

Method. A text is cut into pieces, runs of at most eight code points without white space; an element is a k-mer of ``SIZE``
pieces (fewer at the end) with its occurrence number, so that the second "of the" of a text is another element than the
first. All elements get a 64-bit hash. Each of the ``ENTRIES`` entries has an order of its own: the ring of hashes, read from
the entry's start on. The two first elements in that order are selected, put back into their order in the text, and the pair
of k-mers is hashed to 16 bits. Two fingerprints are as alike as the share of their equal entries: a pair is equal if both texts
have both k-mers in the same order, so moving a passage lowers the likeness where a set of shingles would see no change.

An element is one long: hash above, position in the text below (``PLACE`` bits). Sorting these numbers brings equal k-mers
together in text order, which gives occurrence numbers; sorting the renumbered ones gives the ring. Only the first two
elements behind each start can be selected, so the ring is cut to them before pairs are made. All work on a text stays in its row.

Defined results: a null text counts as empty; a text without pieces has the fingerprint of zeros; a text of one element pairs it with
itself; texts that differ in white space between pieces only are alike. Texts are read whole; one of more than 2^28 pieces cannot be
numbered (no such row fits into Spark's memory). Repeated rows give repeated results.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

PIECE = r"[^\x20\x09-\x0D]{1,8}"
SIZE = 2  # pieces of a k-mer
ENTRIES = 64
BIN = 58  # bits below the number of the entry: 64 entries
PLACE = 28  # bits of a position
_HASH, _AT = -(1 << PLACE), (1 << PLACE) - 1
_LOW = -ENTRIES // 2  # entry numbers are the six highest bits of a signed long

STRIDE = 16
SPREAD = 64  # parts of an id that fills slices by itself: the six highest bits of the order


def _kmer(at: str) -> str:
    """The pieces of a k-mer; those beyond the end are null, which a hash skips."""
    return ", ".join(f"get(_pieces, cast({at} + {i} AS int))" for i in range(SIZE))


def _pair(x: str, y: str) -> str:
    """Hash of two selected k-mers in the order of the text."""
    first, last = (f"{pick}({x} & {_AT}L, {y} & {_AT}L)" for pick in ("least", "greatest"))
    return f"cast(xxhash64({_kmer(first)}, '|', {_kmer(last)}) & 65535 AS int)"


def with_fingerprint(df: DataFrame, text: str, name: str) -> DataFrame:
    """``df`` with the fingerprint of ``text`` as an array of ``ENTRIES`` numbers of 16 bits."""
    kept = list(df.columns)
    steps = {
        "_pieces": f"regexp_extract_all(coalesce(`{text}`, ''), '{PIECE}', 0)".replace("\\", "\\\\"),
        "_sorted": f"sort_array(transform(_pieces, (x, i) -> (xxhash64(x, {', '.join(f'get(_pieces, i + {i})' for i in range(1, SIZE))}) & {_HASH}L) | i))",
        "_starts": f"""filter(transform(_sorted, (x, i) -> if(i > 0 AND shiftright(get(_sorted, i - 1), {PLACE}) = shiftright(x, {PLACE}), -1, i)), i -> i >= 0)""",
        "_ring": f"""sort_array(flatten(transform(_starts, (a, j) -> transform(
            slice(_sorted, a + 1, coalesce(get(_starts, j + 1), size(_sorted)) - a),
            (x, n) -> if(n = 0, x, (xxhash64(shiftright(x, {PLACE}), n) & {_HASH}L) | (x & {_AT}L))))))""",
        "_first": f"filter(_ring, (x, i) -> i < 2 OR shiftright(x, {BIN}) <> shiftright(get(_ring, i - 2), {BIN}))",
        name: f"""if(size(_first) = 0, array_repeat(0, {ENTRIES}), concat(
            flatten(transform(_first, (x, i) -> array_repeat({_pair('x', 'coalesce(get(_first, i + 1), get(_first, 0))')},
                cast(shiftright(x, {BIN}) - coalesce(shiftright(get(_first, i - 1), {BIN}), {_LOW - 1}) AS int)))),
            array_repeat({_pair('get(_first, 0)', 'coalesce(get(_first, 1), get(_first, 0))')},
                cast({_LOW + ENTRIES - 1} - shiftright(element_at(_first, -1), {BIN}) AS int))))""",
    }
    for step, rule in steps.items():
        df = df.withColumn(step, F.expr(rule))
    return df.select(*kept, name)


def as_text(fingerprint: str) -> Column:
    """Four hexadecimal digits an entry."""
    return F.expr(f"array_join(transform(`{fingerprint}`, x -> lpad(lower(hex(x)), 4, '0')), '')")


def likeness(a: str, b: str) -> Column:
    """Share of equal entries, 0 to 1."""
    return F.expr(f"size(filter(zip_with(`{a}`, `{b}`, (x, y) -> x = y), x -> x)) / {float(ENTRIES)}D")


def with_next(docs: DataFrame, ident: str, order: str, columns: list[str]) -> DataFrame:
    """``docs`` with ``next_<c>``, the values of the row that follows when ids descend; the first row follows the last.

    Rows of one id stand in the order of the hash ``order``, null ids at the end. No task sorts the whole table: ids are
    dealt to slices at approximate quantiles, and an id that holds whole slices by itself (as null may) is split by the hash.
    The first row of each slice is repeated at the end of the slice before, so a window inside each slice sees every successor.
    """
    width = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    slices = STRIDE * max(4, -(-4 * width // STRIDE))
    cuts = (
        docs.agg(F.percentile_approx(ident, [i / slices for i in range(1, slices)], 10000).alias("fine"))
        .selectExpr(
            f"struct(reverse(fine) AS fine, filter(reverse(fine), (c, i) -> i % {STRIDE} = {STRIDE - 1}) AS coarse,"
            " array_distinct(filter(fine, (c, i) -> c = get(fine, i - 1))) AS heavy) AS cuts"
        )
        .scalar()
    )
    above = f"(c -> c > `{ident}`)"
    placed = (
        docs.withColumn("_cuts", cuts)
        .withColumn("_low", F.expr(f"{STRIDE} * size(filter(_cuts.coarse, {above}))"))
        .withColumn("_slice", F.expr(f"if(`{ident}` IS NULL, {slices}, coalesce(_low + size(filter(slice(_cuts.fine, _low + 1, {STRIDE}), {above})), 0))"))
        .withColumn("_part", F.expr(f"if(`{ident}` IS NULL OR coalesce(array_contains(_cuts.heavy, `{ident}`), false), 1 + {SPREAD // 2} + shiftright(`{order}`, 58), 0)"))
        .select(*docs.columns, "_slice", F.col("_part").cast("int").alias("_part"))
    )
    # the first row of each slice: a few rows for each task of a shuffle, whatever the size of the table
    firsts = placed.groupBy("_slice", "_part").agg(F.max(F.struct(F.col(ident).alias("i"), F.bitwise_not(order).alias("o"))).alias("first"))
    ring = Window.orderBy("_slice", "_part")
    last = F.max(F.struct("_slice", "_part")).over(Window.partitionBy())
    heads = firsts.select("_slice", "_part", "first", F.coalesce(F.lag(F.struct("_slice", "_part")).over(ring), last).alias("_to"))
    marked = placed.join(F.broadcast(heads), ["_slice", "_part"])
    is_first = F.col(ident).eqNullSafe(F.col("first.i")) & (F.bitwise_not(order) == F.col("first.o"))
    own = F.struct("_slice", "_part", F.lit(0).alias("_ghost"))
    ghost = F.struct(F.col("_to._slice").alias("_slice"), F.col("_to._part").alias("_part"), F.lit(1).alias("_ghost"))
    dealt = marked.select(*docs.columns, F.inline(F.when(is_first, F.array(own, ghost)).otherwise(F.array(own))))
    within = Window.partitionBy("_slice", "_part").orderBy("_ghost", F.col(ident).desc(), order)
    found = dealt.withColumns({f"next_{c}": F.lead(c).over(within) for c in columns})
    return found.where("_ghost = 0").select(*docs.columns, *[f"next_{c}" for c in columns])


def edit_report(docs: DataFrame) -> DataFrame:
    """Per document its fingerprint, that of the text whose last third is replaced by the beginning of the next document, and the
    likeness of its fingerprint to both that and the next document's."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("order", F.xxhash64("text"))
    printed = with_fingerprint(rows, "text", "print")
    n = F.char_length("text")
    third = F.floor(n / 3).cast("int")
    paired = with_next(printed, "doc_id", "order", ["text", "print"])
    edited = paired.select(
        "doc_id", n.cast("long").alias("n_chars"), "print", "next_print",
        F.concat(F.substring("text", F.lit(1), n - third), F.substring("next_text", F.lit(1), third)).alias("edited"),
    )
    return with_fingerprint(edited, "edited", "edited_print").select(
        "doc_id", "n_chars", F.sha2("edited", 256).alias("edited_sha256"),
        as_text("print").alias("fingerprint"), as_text("edited_print").alias("edited_fingerprint"),
        likeness("print", "edited_print").alias("near_edited"), likeness("print", "next_print").alias("near_next"),
    )
