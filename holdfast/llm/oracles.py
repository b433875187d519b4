"""DuckDB SQL for the queries that SQL can express, written from their contracts."""

from __future__ import annotations

from holdfast.llm import quality_rules

#: Removal of repeated strings of 400 bytes; a text is its bytes in hexadecimal, two digits each.
SUFFIX_DEDUP = """
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
w AS (SELECT doc_id, unnest(range(0, length(h) // 2 - 399)) AS i, h FROM d WHERE length(h) >= 800),
m AS (SELECT doc_id, i, md5(substring(h, 2 * i + 1, 800)) AS x FROM w),
r AS (SELECT doc_id, i FROM m WHERE x IN (SELECT x FROM m GROUP BY x HAVING count(*) > 1)),
s AS (SELECT doc_id, i, CASE WHEN i - lag(i) OVER (PARTITION BY doc_id ORDER BY i) <= 400 THEN 0 ELSE 1 END AS fresh FROM r),
n AS (SELECT doc_id, i, sum(fresh) OVER (PARTITION BY doc_id ORDER BY i) AS run FROM s),
runs AS (SELECT doc_id, run, min(i) AS lo, max(i) + 400 AS hi FROM n GROUP BY doc_id, run),
cuts AS (
  SELECT d.doc_id, h, coalesce(lag(hi) OVER (PARTITION BY d.doc_id ORDER BY lo), 0) AS a, lo AS b FROM d JOIN runs USING (doc_id)
  UNION ALL
  SELECT d.doc_id, any_value(h), coalesce(max(hi), 0), any_value(length(h)) // 2 FROM d LEFT JOIN runs USING (doc_id) GROUP BY d.doc_id),
kept AS (SELECT doc_id, sum(b - a) AS n, sha256(unhex(string_agg(substring(h, 2 * a + 1, 2 * (b - a)), '' ORDER BY a))) AS sha FROM cuts GROUP BY doc_id)
SELECT d.doc_id, length(h) // 2 AS n_bytes, (length(h) // 2 - n)::BIGINT AS n_removed,
  (SELECT count(*) FROM runs WHERE runs.doc_id = d.doc_id) AS n_spans, sha AS kept_sha256
FROM d JOIN kept USING (doc_id)
"""


def _hashed(n: int) -> str:
    """Bin of the n-gram that starts at a byte."""
    h = "0::UBIGINT"
    for k in range(n):
        h = f"((({h} + b{k} + 1) * 2654435761::UBIGINT) & 4294967295::UBIGINT)"
        h = f"list_transform([{h}], lambda h{k}: xor(h{k}, h{k} >> 15))[1]"
    return f"({h} & {quality_rules.BINS - 1})"


_WORD = r"[^\x20\x09-\x0D]"
_LEADS = ", ".join(f"lead(b, {k}) OVER (PARTITION BY doc_id ORDER BY i) AS b{k}" for k in range(1, 4))
_GRAMS = " UNION ALL ".join(f"SELECT doc_id, {_hashed(n)} AS bin FROM bytes WHERE b{n - 1} IS NOT NULL" for n in quality_rules.SIZES)

#: Quality rules; fewer rows have labels here than the fit may use at most.
QUALITY_RULES = f"""
WITH docs AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
words AS (
  SELECT doc_id, unnest(ws) AS w, generate_subscripts(ws, 1) AS i
  FROM (SELECT doc_id, regexp_extract_all(text, '{_WORD}+') AS ws FROM docs)),
sized AS (SELECT doc_id, count(*) AS n_words, sum(length(w)) AS word_chars FROM words GROUP BY doc_id),
next AS (
  SELECT doc_id, i, w, lead(w) OVER (PARTITION BY doc_id ORDER BY i) AS w2, lead(w, 2) OVER (PARTITION BY doc_id ORDER BY i) AS w3 FROM words),
again AS (SELECT doc_id, i FROM (SELECT *, count(*) OVER (PARTITION BY doc_id, w, w2, w3) AS n FROM next WHERE w3 IS NOT NULL) WHERE n > 1),
repeated AS (SELECT doc_id, count(DISTINCT i + k) AS n FROM again, (SELECT unnest([0, 1, 2]) AS k) GROUP BY doc_id),
lines AS (
  SELECT doc_id, unnest(ls) AS line, generate_subscripts(ls, 1) AS i FROM (SELECT doc_id, string_split(text, chr(10)) AS ls FROM docs)),
dups AS (
  SELECT doc_id, count(*) AS n FROM (SELECT *, row_number() OVER (PARTITION BY doc_id, line ORDER BY i) AS r FROM lines)
  WHERE r > 1 AND regexp_matches(line, '{_WORD}') GROUP BY doc_id),
bytes AS (
  SELECT *, b AS b0, {_LEADS} FROM (
    SELECT doc_id, i, ('0x' || substring(h, 2 * i + 1, 2))::UBIGINT AS b
    FROM (SELECT doc_id, h, unnest(range(0, length(h) // 2)) AS i FROM (SELECT doc_id, hex(encode(text)) AS h FROM docs)))),
grams AS ({_GRAMS}),
counted AS (SELECT doc_id, bin, count(*) AS n FROM grams GROUP BY doc_id, bin),
trusted AS (SELECT doc_id FROM labels GROUP BY doc_id HAVING min(quality) = 1 AND max(quality) = 1),
bins AS (
  SELECT bin, sum(n) AS raw, coalesce(sum(n) FILTER (WHERE doc_id IN (SELECT doc_id FROM trusted)), 0) AS target FROM counted GROUP BY bin),
totals AS (SELECT sum(raw) AS raw, sum(target) AS target FROM bins),
weights AS (
  SELECT bin, ln((b.target + 1e0) / (t.target + {quality_rules.BINS})) - ln((b.raw + 1e0) / (t.raw + {quality_rules.BINS})) AS v FROM bins b, totals t),
scores AS (SELECT doc_id, sum(n * v) / sum(n) AS s FROM counted JOIN weights USING (bin) GROUP BY doc_id),
base AS (
  SELECT doc_id, coalesce(n_words, 0) AS n_words, coalesce(word_chars, 0)::BIGINT AS word_chars,
    length(regexp_replace(text, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(dups.n, 0) AS n_dup_lines, coalesce(repeated.n, 0) AS n_repeat_words
  FROM docs LEFT JOIN sized USING (doc_id) LEFT JOIN dups USING (doc_id) LEFT JOIN repeated USING (doc_id)),
judged AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM base)
SELECT j.*, NOT base_failed AND coalesce(s, 0) >= {quality_rules.THRESHOLD} AS kept FROM judged j LEFT JOIN scores USING (doc_id)
"""


def _crc32(text: str) -> str:
    """CRC-32 of a column of ASCII text: its codes, each followed by eight shifts (-1)."""
    codes = f"flatten(list_transform(range(1, length({text}) + 1), lambda i: list_concat([ord({text}[i])::BIGINT], list_transform(range(8), lambda z: -1::BIGINT))))"
    step = "CASE WHEN e >= 0 THEN xor(a, e) ELSE xor(a >> 1, 3988292384::BIGINT * (a & 1)) END"
    return f"xor(list_reduce(list_concat([4294967295::BIGINT], {codes}), lambda a, e: {step}), 4294967295::BIGINT)"


#: Trie of rebuilt conversations; a node is the JSON of its turns.
PREFIX_TRIE = f"""
WITH turns AS (SELECT conv_id AS c, turn, coalesce(role, '') AS r, coalesce(text, '') AS x FROM conversations WHERE conv_id IS NOT NULL),
own AS (SELECT c, c::VARCHAR AS s, list({{'r': r, 'x': x}} ORDER BY turn NULLS FIRST, r, x) AS ts FROM turns GROUP BY c),
counted AS (SELECT c, ts, {_crc32('s')} % 4 AS h FROM own),
rebuilt AS (
  SELECT o.c, CASE WHEN b.c IS NULL THEN o.ts[h + 1:] ELSE list_concat(b.ts[1:h], o.ts[h + 1:]) END AS ts
  FROM counted o LEFT JOIN own b ON b.c = o.c - o.c % 20),
members AS (
  SELECT c, d, len(ts) AS size, md5(to_json(ts[1:d])::VARCHAR) AS k, CASE WHEN d > 0 THEN md5(to_json(ts[1:d - 1])::VARCHAR) END AS pk,
    CASE WHEN d > 0 THEN len(regexp_extract_all(ts[d].x, '{_WORD}+')) ELSE 0 END AS words
  FROM (SELECT c, ts, unnest(range(0, len(ts) + 1)) AS d FROM rebuilt)),
nodes AS (
  SELECT k, any_value(d) AS d, any_value(pk) AS pk, min(c) AS c, count(*) AS n, any_value(words) AS words,
    string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE size = d) AS ends
  FROM members GROUP BY k),
children AS (SELECT pk AS k, count(*) AS m FROM nodes WHERE pk IS NOT NULL GROUP BY pk),
valued AS (SELECT nodes.*, coalesce(m, 0) AS m, (n - 1) * words AS worth FROM nodes LEFT JOIN children USING (k)),
sums AS (
  SELECT a.k, count(*) FILTER (WHERE v.m = 0) AS leaves, sum(v.worth) AS worth
  FROM valued v JOIN members a ON a.c = v.c AND a.d <= v.d GROUP BY a.k)
SELECT v.c AS conv_id, v.d::BIGINT AS depth, p.c AS parent_conv_id, v.n AS n_convs, v.m AS n_children, leaves AS n_leaves,
  sums.worth::BIGINT AS saved_tokens, sha256(coalesce(v.ends, '')) AS ends_sha256
FROM valued v JOIN sums USING (k) LEFT JOIN nodes p ON p.k = v.pk
"""


def _encoded(values: list[str]) -> str:
    return "sha256(" + " || ".join(f"coalesce(strlen({v}::VARCHAR) || ':' || {v}::VARCHAR, '-')" for v in values) + ")"


_PAIRS = "list_transform(range(0, (len(ns) + 1) // 2), lambda i: sha256(ns[2 * i + 1] || coalesce(ns[2 * i + 2], '')))"
_STEP = """CASE WHEN (ix & 1) = 1 THEN 'L' || ns[ix] WHEN ix + 2 <= len(ns) THEN 'R' || ns[ix + 2] ELSE 'N' END"""

#: Merkle proofs: the nodes of every level as one list, siblings by the bits of a leaf's rank.
MERKLE = f"""
WITH RECURSIVE hashed AS (
  SELECT doc_id, lang, {_encoded(['doc_id', 'source', 'lang', 'n_chars', 'text'])} AS leaf,
    CASE WHEN {_crc32('s')} % 7 = 0 THEN {_encoded(['doc_id', 'source', 'lang', '(n_chars + 1)', 'text'])}
      ELSE {_encoded(['doc_id', 'source', 'lang', 'n_chars', 'text'])} END AS claim
  FROM (SELECT *, doc_id::VARCHAR AS s FROM documents)),
ranked AS (
  SELECT *, dense_rank() OVER (ORDER BY lang NULLS FIRST) - 1 AS tree, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS pos FROM hashed),
levels AS (
  SELECT tree, 0 AS level, list(leaf ORDER BY pos) AS ns FROM ranked GROUP BY tree
  UNION ALL SELECT tree, level + 1, {_PAIRS} FROM levels WHERE len(ns) > 1),
subroots AS (SELECT tree, ns[1] AS subroot FROM levels WHERE len(ns) = 1),
above AS (
  SELECT 0 AS level, list(subroot ORDER BY tree) AS ns FROM subroots
  UNION ALL SELECT level + 1, {_PAIRS} FROM above WHERE len(ns) > 1),
root AS (SELECT ns[1] AS root FROM above WHERE len(ns) = 1),
inner_steps AS (SELECT tree, pos, list({_STEP} ORDER BY level) AS st FROM (SELECT r.tree, pos, level, ns, (pos >> level)::BIGINT AS ix FROM ranked r JOIN levels l ON l.tree = r.tree AND len(ns) > 1) GROUP BY tree, pos),
outer_steps AS (SELECT tree, list({_STEP} ORDER BY level) AS st FROM (SELECT tree, level, ns, (tree >> level)::BIGINT AS ix FROM subroots, above WHERE len(ns) > 1) GROUP BY tree),
proofs AS (
  SELECT r.*, subroot, list_concat(coalesce(i.st, []::VARCHAR[]), coalesce(o.st, []::VARCHAR[])) AS st
  FROM ranked r JOIN subroots USING (tree) LEFT JOIN inner_steps i ON i.tree = r.tree AND i.pos = r.pos LEFT JOIN outer_steps o ON o.tree = r.tree),
folded AS (
  SELECT *, sha256(array_to_string(list_transform(st, lambda s: s[2:]), '')) AS proof,
    list_reduce(list_concat([claim], st), lambda a, s: sha256(CASE s[1] WHEN 'L' THEN s[2:] || a WHEN 'R' THEN a || s[2:] ELSE a END)) AS top
  FROM proofs)
SELECT doc_id, leaf, subroot, root, proof AS proof_sha256, top AS folded_root, top = root AS verified FROM folded, root
"""
