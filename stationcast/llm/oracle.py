"""DuckDB SQL for the queries that SQL can express, formulated in long form: one row per word, shingle, window or bin."""

from __future__ import annotations

from . import quality as Q

_BREAK = r"[\x20\x09-\x0D]+"
_NO_BREAK = r"[^\x20\x09-\x0D]"
_WORDS = f"list_filter(regexp_split_to_array(%s, '{_BREAK}'), lambda x: x <> '')"
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
_LOWERED = f"translate(coalesce(text, ''), '{_UPPER}', '{_UPPER.lower()}')"

_NEAR = f"""
WITH RECURSIVE d AS (SELECT row_number() OVER () AS rid, doc_id, {_WORDS % _LOWERED} AS ws FROM documents),
places AS (SELECT rid, doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i FROM d WHERE len(ws) > 0),
sh AS (SELECT DISTINCT rid, doc_id, array_to_string(ws[i:i + 4], ' ') AS s FROM places),
n AS (SELECT rid, any_value(doc_id) AS doc_id, count(*) AS n FROM sh GROUP BY 1),
pairs AS (SELECT a.rid AS x, b.rid AS y, count(*) AS shared FROM sh a JOIN sh b ON a.s = b.s AND a.rid <> b.rid
          WHERE a.doc_id IS NOT NULL AND b.doc_id IS NOT NULL GROUP BY 1, 2),
links AS (SELECT DISTINCT p.doc_id AS x, q.doc_id AS y FROM pairs JOIN n p ON p.rid = x JOIN n q ON q.rid = y
          WHERE 100 * shared >= 85 * (p.n + q.n - shared)),
reach(doc_id, other) AS (SELECT doc_id, doc_id FROM d WHERE doc_id IS NOT NULL
                         UNION SELECT r.doc_id, l.y FROM reach r JOIN links l ON l.x = r.other),
least AS (SELECT doc_id, min(other) AS component_id FROM reach GROUP BY 1)
SELECT d.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles, l.component_id, d.doc_id IS NOT DISTINCT FROM l.component_id AS kept
FROM d LEFT JOIN n USING (rid) LEFT JOIN least l ON l.doc_id = d.doc_id"""

_CLASSES = [("lower", r"[\p{Ll}\p{Lt}\p{Lm}\p{Lo}]"), ("upper", r"\p{Lu}"), ("digit", r"\p{N}"), ("space", r"[ \t\n\x0B\f\r]"),
            ("punctuation", r"[.,;:!?\x27\x22()-]"), ("symbol", r"[#*$%&|<>]")]
_CLASS_BINS = " UNION ALL ".join(
    f"SELECT rid, lang, n_words, 'c' AS h, '{name}' AS bin, length(t) - length(regexp_replace(t, '{pattern}', '', 'g')) AS c, length(t) AS n FROM w"
    for name, pattern in _CLASSES)
_COMMON = ", ".join(f"('{x}')" for x in Q.COMMON_WORDS)

_QUALITY = f"""
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, lang, coalesce(text, '') AS t FROM documents),
w AS (SELECT *, {_WORDS % "t"} AS ws, len({_WORDS % "t"}) AS n_words,
             list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '{_NO_BREAK}')) AS lines FROM d),
win AS (SELECT rid, i, array_to_string(ws[i:i + 7], ' ') AS s FROM (SELECT rid, ws, unnest(range(1, n_words - 6)) AS i FROM w WHERE n_words >= 8)),
again AS (SELECT rid, i FROM (SELECT rid, i, count(*) OVER (PARTITION BY rid, s) AS c FROM win) WHERE c > 1),
rep AS (SELECT rid, sum(least(8, step)) AS n FROM (SELECT rid, coalesce(lead(i) OVER (PARTITION BY rid ORDER BY i) - i, 8) AS step FROM again)
        GROUP BY 1),
one AS (SELECT rid, lang, n_words, lower(unnest(ws)) AS x FROM w),
hits AS (SELECT rid, x, count(*) AS c FROM one WHERE x IN (SELECT * FROM (VALUES {_COMMON})) GROUP BY 1, 2),
word_bins AS (
  SELECT w.rid, w.lang, w.n_words, 'w' AS h, k.x AS bin, coalesce(hits.c, 0) AS c, w.n_words AS n
  FROM w CROSS JOIN (VALUES {_COMMON}) k(x) LEFT JOIN hits ON hits.rid = w.rid AND hits.x = k.x),
bins AS (
  SELECT * FROM word_bins
  UNION ALL SELECT w.rid, w.lang, w.n_words, 'w', ' ', w.n_words - coalesce(s.c, 0), w.n_words
  FROM w LEFT JOIN (SELECT rid, sum(c) AS c FROM hits GROUP BY 1) s USING (rid)
  UNION ALL ({_CLASS_BINS})),
every AS (
  SELECT * FROM bins
  UNION ALL SELECT rid, any_value(lang), any_value(n_words), 'c', 'other', any_value(n) - sum(c), any_value(n) FROM bins WHERE h = 'c' GROUP BY 1),
parts AS (SELECT rid, lang, n_words, h, bin, CASE WHEN n > 0 THEN CAST(c AS BIGINT) * 1000000 // n ELSE 0 END AS p FROM every),
ref AS (SELECT lang, h, bin, sum(p) / (count(*) * 1000000) AS q FROM parts WHERE n_words > 0 GROUP BY 1, 2, 3),
term AS (SELECT rid, parts.h, p / 1000000 AS a, q AS b FROM parts LEFT JOIN ref ON ref.lang IS NOT DISTINCT FROM parts.lang
         AND ref.h = parts.h AND ref.bin = parts.bin),
far AS (
  SELECT rid, h, round(coalesce(sqrt(greatest(0, sum(CASE WHEN b IS NULL THEN NULL ELSE
      CASE WHEN a > 0 THEN a * log2(a * 2 / (a + b)) ELSE 0 END + CASE WHEN b > 0 THEN b * log2(b * 2 / (a + b)) ELSE 0 END END) / 2)), 0), 6) AS js
  FROM term GROUP BY 1, 2),
facts AS (
  SELECT w.doc_id, w.n_words, list_sum(list_transform(ws, lambda x: length(x))) AS chars, length(t) AS n_chars,
         length(t) - length(regexp_replace(t, '[#*$%&|<>]', '', 'g')) AS n_symbols, len(lines) - len(list_distinct(lines)) AS n_dup_lines,
         coalesce(rep.n, 0) AS n_repeat_words, c.js AS class_distance, v.js AS word_distance,
         w.n_words < {Q.MIN_WORDS} OR 100 * coalesce(rep.n, 0) > {Q.REPEAT_PERCENT} * w.n_words AS base_failed
  FROM w LEFT JOIN rep USING (rid) JOIN far c ON c.rid = w.rid AND c.h = 'c' JOIN far v ON v.rid = w.rid AND v.h = 'w')
SELECT doc_id, CAST(n_words AS BIGINT) AS n_words, CAST(coalesce(chars, 0) AS BIGINT) AS word_chars, CAST(n_symbols AS BIGINT) AS n_symbols,
       CAST(n_dup_lines AS BIGINT) AS n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, base_failed,
       NOT base_failed AND NOT (n_chars >= {Q.CLASS_MIN_CHARS} AND class_distance > {Q.CLASS_LIMIT})
       AND NOT (n_words >= {Q.WORD_MIN_WORDS} AND word_distance > {Q.WORD_LIMIT}) AS kept,
       class_distance, word_distance FROM facts"""

_REPEATS = """
WITH d AS (SELECT row_number() OVER () AS rid, doc_id, encode(coalesce(text, '')) AS raw FROM documents),
hexed AS (SELECT rid, doc_id, hex(raw) AS x, octet_length(raw) AS n FROM d),
win AS (SELECT rid, i, md5(substr(x, 2 * i + 1, 400)) AS s FROM (SELECT rid, x, unnest(range(0, n - 199)) AS i FROM hexed WHERE n >= 200)),
again AS (SELECT rid, i FROM win WHERE s IN (SELECT s FROM win GROUP BY s HAVING count(*) > 1)),
steps AS (SELECT rid, i, CASE WHEN i <= lag(i) OVER (PARTITION BY rid ORDER BY i) + 200 THEN 0 ELSE 1 END AS new FROM again),
runs AS (SELECT rid, min(i) AS lo, max(i) + 200 AS hi FROM (SELECT rid, i, sum(new) OVER (PARTITION BY rid ORDER BY i) AS k FROM steps) GROUP BY rid, k),
before AS (SELECT r.rid, r.lo, r.hi, coalesce(lag(r.hi) OVER (PARTITION BY r.rid ORDER BY r.lo), 0) AS prev FROM runs r),
kept AS (
  SELECT b.rid, sum(b.hi - b.lo) AS n_removed, count(*) AS n_spans,
         string_agg(substr(h.x, 2 * b.prev + 1, 2 * (b.lo - b.prev)), '' ORDER BY b.lo) || substr(any_value(h.x), 2 * max(b.hi) + 1) AS x
  FROM before b JOIN hexed h USING (rid) GROUP BY 1)
SELECT h.doc_id, CAST(h.n AS BIGINT) AS n_bytes, CAST(coalesce(k.n_removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(k.n_spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.x, h.x))) AS kept_sha256
FROM hexed h LEFT JOIN kept k USING (rid)"""

_BASE32 = " || ".join(
    f"substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + (((('0x' || substr(hex, {1 + 5 * g}, 5))::BIGINT >> {15 - 5 * k}) & 31)::INT), 1)"
    for g in range(8) for k in range(4))

_SHARDS = 8
_CUTS = "SELECT *, (lo + hi) // 2 AS mid, 0::BIGINT AS c0 FROM search WHERE lo < hi"
for _k in range(1, _SHARDS):
    _CUTS = f"SELECT *, CASE WHEN {_k} < m THEN list_max(list_filter(ends, lambda p: p <= c{_k - 1} + mid)) ELSE c{_k - 1} END AS c{_k} FROM ({_CUTS})"
_FOUND = "SELECT *, 0::BIGINT AS c0 FROM search WHERE lo = hi"
for _k in range(1, _SHARDS):
    _FOUND = f"SELECT *, CASE WHEN {_k} < m THEN list_max(list_filter(ends, lambda p: p <= c{_k - 1} + hi)) ELSE c{_k - 1} END AS c{_k} FROM ({_FOUND})"
_CRC_TABLE = ("list_transform(range(256), lambda n: list_reduce(list_prepend(n, range(8)), "
              "lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END))")


def _crc32(blob: str, table: str) -> str:
    """The CRC-32 of a blob, byte by byte, with the 256-entry ``table``."""
    octets = f"list_transform(regexp_extract_all(hex({blob}), '..'), lambda x: ('0x' || x)::BIGINT)"
    return f"xor(list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor({table}[(xor(c, b) & 255) + 1], c >> 8)), 4294967295)"


_SHARDING = f"""
WITH RECURSIVE crc AS (SELECT {_CRC_TABLE} AS tab),
d AS (SELECT doc_id, octet_length(encode(coalesce(text, ''))) + 1 AS size, sha256(coalesce(text, '')) AS k,
             {_crc32("encode(coalesce(text, ''))", "tab")} AS text_crc32 FROM documents, crc),
g AS (SELECT k, sum(size)::BIGINT AS b FROM d GROUP BY k),
ranked AS (SELECT k, b, row_number() OVER (ORDER BY b DESC, k) - 1 AS i, sum(b) OVER () - sum(b) OVER (ORDER BY b DESC, k) + b AS remaining FROM g),
alone AS (SELECT k, i FROM (SELECT k, i, bool_and(b * ({_SHARDS} - i) > remaining) OVER (ORDER BY i) AS large FROM ranked) WHERE large),
line AS (SELECT k, b, sum(b) OVER (ORDER BY k)::BIGINT AS upto FROM g WHERE k NOT IN (SELECT k FROM alone)),
facts AS (SELECT list(upto ORDER BY upto) AS ends, sum(b)::BIGINT AS total, max(b) AS largest, {_SHARDS} - (SELECT count(*) FROM alone) AS m FROM line),
search AS (
  SELECT ends, total, m, greatest(largest, -(-total // m)) AS lo, -(-total // m) + largest AS hi FROM facts WHERE total > 0
  UNION ALL
  SELECT ends, total, m, CASE WHEN total - c{_SHARDS - 1} <= mid THEN lo ELSE mid + 1 END, CASE WHEN total - c{_SHARDS - 1} <= mid THEN mid ELSE hi END
  FROM ({_CUTS})),
cuts AS (SELECT m, unnest([{", ".join(f"c{k}" for k in range(1, _SHARDS))}]) AS c, unnest(range(1, {_SHARDS})) AS j FROM ({_FOUND})),
placed AS (
  SELECT k, i AS shard FROM alone
  UNION ALL
  SELECT k, {_SHARDS} - any_value(m) + count(*) FILTER (WHERE j < m AND upto > c) FROM line, cuts GROUP BY k)
SELECT doc_id, size::BIGINT AS size, text_crc32::BIGINT AS text_crc32, 'bytes' AS law, shard::INT AS shard,
       row_number() OVER (PARTITION BY shard ORDER BY doc_id NULLS FIRST, k) - 1 AS slot, NULL::INT AS grown_shard
FROM d JOIN placed USING (k)"""

_NEGATIVES = """
WITH v AS (
  SELECT row_number() OVER () AS rid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS q
  FROM embeddings WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.rid AS a_rid, a.vec_id AS anchor_id, b.rid, b.vec_id, a.label = b.label AS same, list_inner_product(a.q, b.q)::BIGINT AS score
      FROM v a JOIN v b ON a.rid <> b.rid WHERE a.vec_id % 50 = 0),
pos AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a_rid ORDER BY score DESC, vec_id, rid) <= 5)
SELECT pos.anchor_id, pos.vec_id AS positive_id, row_number() OVER (PARTITION BY pos.a_rid, pos.rid ORDER BY neg.score DESC, neg.vec_id, neg.rid)::INT AS rank,
       neg.vec_id AS negative_id, pos.score AS positive_score, neg.score AS negative_score
FROM pos JOIN s neg ON neg.a_rid = pos.a_rid AND NOT neg.same AND 50 * pos.score <= 100 * neg.score AND 100 * neg.score <= 95 * pos.score
QUALIFY rank <= 3"""

_TRIE = f"""
WITH crc AS (SELECT {_CRC_TABLE} AS tab),
t AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations WHERE conv_id IS NOT NULL),
coded AS (SELECT conv_id, turn, substr(sha256(octet_length(encode(role)) || ':' || role || text), 1, 32)
                 || lpad(printf('%x', octet_length(encode(text))), 16, '0') AS code FROM t),
own AS (SELECT conv_id, list(code ORDER BY turn NULLS FIRST, code) AS turns, {_crc32("encode(conv_id::VARCHAR)", "any_value(tab)")} % 9 AS h
        FROM coded, crc GROUP BY conv_id),
built AS (SELECT o.conv_id, list_concat(coalesce(b.turns, [])[1:o.h], o.turns[o.h + 1:]) AS path
          FROM own o LEFT JOIN own b ON b.conv_id = o.conv_id - o.conv_id % 5),
steps AS (SELECT conv_id, len(path) AS total, unnest(range(0, len(path) + 1)) AS depth, path FROM built),
n AS (SELECT array_to_string(path[1:depth], '') AS node, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
             sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (WHERE total = depth), '')) AS ends_sha256
      FROM steps GROUP BY 1, 2),
kids AS (SELECT substr(node, 1, length(node) - 48) AS node, count(*) AS k FROM n WHERE depth > 0 GROUP BY 1),
facts AS (SELECT n.*, coalesce(k, 0) AS n_children,
                 CASE WHEN depth = 0 THEN 0 ELSE (n_convs - 1) * ('0x' || substr(n.node, length(n.node) - 15))::BIGINT END AS saved
          FROM n LEFT JOIN kids USING (node)),
up AS (SELECT unnest(list_transform(range(0, depth + 1), lambda d: substr(node, 1, 48 * d))) AS node, saved, (n_children = 0)::BIGINT AS leaf FROM facts),
sums AS (SELECT node, sum(leaf)::BIGINT AS n_leaves, sum(saved)::BIGINT AS saved_tokens FROM up GROUP BY 1)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
       s.n_leaves, s.saved_tokens, f.ends_sha256
FROM facts f JOIN sums s USING (node) LEFT JOIN facts p ON f.depth > 0 AND p.node = substr(f.node, 1, length(f.node) - 48)"""

SQL: dict[str, str] = {
    "op1_minhash_near_dedup": _NEAR,
    "op3_quality_rules": _QUALITY,
    "op8_suffix_dedup": _REPEATS,
    "op11_hard_negatives": _NEGATIVES,
    "op12_sharding": _SHARDING,
    "op13_prefix_trie": _TRIE,
    "op7_warc": f"""
WITH p AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
h AS (SELECT page_id, html, octet_length(encode(html))::BIGINT AS payload_bytes, sha1(html) AS hex,
             max(page_id) OVER (PARTITION BY html) AS last FROM p)
SELECT page_id, payload_bytes, {_BASE32} AS payload_digest,
       CASE WHEN page_id IS DISTINCT FROM last AND last IS NOT NULL THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM last THEN last END AS refers_to
FROM h""",
}
