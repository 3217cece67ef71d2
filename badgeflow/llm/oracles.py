"""SQL equivalents of the queries that SQL can express on whole tables."""

from __future__ import annotations

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def ascii_lower(text: str) -> str:
    return f"translate({text}, '{UPPER}', '{LOWER}')"


SPACE = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"

LINE_DEDUP = f"""
WITH lines AS (
  SELECT doc_id, unnest(ls) AS line, unnest(range(len(ls))) AS i
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS ls FROM documents)),
keyed AS (SELECT *, {ascii_lower(f'trim(line, {SPACE})')} AS key FROM lines),
frequent AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
judged AS (
  SELECT k.doc_id, k.line, k.i, f.keeper IS NOT NULL AND f.keeper <> k.doc_id AS dropped
  FROM keyed k LEFT JOIN frequent f ON f.key = k.key)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE dropped) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (WHERE NOT dropped), '')) AS kept_sha256
FROM judged GROUP BY doc_id"""

NGRAM_JOIN = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({ascii_lower("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS ws FROM documents),
grams AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM split WHERE len(ws) > 0)),
sizes AS (SELECT doc_id, count(*) AS n FROM grams GROUP BY doc_id),
shared AS (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n
  FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id GROUP BY 1, 2),
links AS (
  SELECT s.a, s.b FROM shared s JOIN sizes x ON x.doc_id = s.a JOIN sizes y ON y.doc_id = s.b
  WHERE 100 * s.n >= 85 * (x.n + y.n - s.n)),
reached AS (
  SELECT doc_id AS a, doc_id AS b FROM documents
  UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT d.doc_id, coalesce(s.n, 0) AS n_shingles, r.component_id FROM documents d
LEFT JOIN sizes s ON s.doc_id = d.doc_id
JOIN (SELECT a, min(b) AS component_id FROM reached GROUP BY a) r ON r.a = d.doc_id"""

WORDS = f"""regexp_extract_all({ascii_lower("coalesce(text, '')")}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"""

DECONTAMINATE = f"""
WITH words AS (SELECT doc_id, {WORDS} AS ws FROM documents),
item_words AS (SELECT item_id, {WORDS} AS ws FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(ws), 10) AS n, array_to_string(list_slice(ws, i, i + 9), ' ') AS w
  FROM (SELECT item_id, ws, unnest(range(1, greatest(len(ws) - 9, 1) + 1)) AS i FROM item_words WHERE len(ws) > 0)),
lengths AS (SELECT DISTINCT n FROM windows),
places AS (
  SELECT doc_id, n, i, array_to_string(list_slice(ws, i, i + n - 1), ' ') AS w
  FROM (SELECT doc_id, ws, n, unnest(range(1, len(ws) - n + 2)) AS i FROM words JOIN lengths ON len(ws) >= n)),
hits AS (SELECT p.doc_id, p.i, p.n, o.item_id FROM places p JOIN windows o ON o.w = p.w AND o.n = p.n),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM hits)) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS id FROM hits) GROUP BY doc_id)
SELECT w.doc_id, len(w.ws) AS n_words, coalesce(h.n_hit, 0) AS n_hit, coalesce(i.n_items, 0) AS n_items,
  sha256(coalesce(i.ids, '')) AS items_sha256, coalesce(h.n_hit, 0) > 0 AS contaminated
FROM words w LEFT JOIN hit h ON h.doc_id = w.doc_id LEFT JOIN items i ON i.doc_id = w.doc_id"""

# Base32 takes the 160 bits five at a time; each group lies within three hex digits.
WARC = """
WITH hashed AS (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages),
groups AS (SELECT hex, unnest(range(0, 32)) AS j FROM (SELECT DISTINCT hex FROM hashed)),
digits AS (SELECT hex, j, CAST('0x' || substr(hex || '0', 5 * j // 4 + 1, 3) AS BIGINT) AS v, 7 - 5 * j % 4 AS low FROM groups),
codes AS (
  SELECT hex, string_agg(substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST((v >> low) & 31 AS BIGINT) + 1, 1), '' ORDER BY j) AS payload_digest
  FROM digits GROUP BY hex),
firsts AS (SELECT hex, min(page_id) AS first FROM hashed GROUP BY hex)
SELECT h.page_id, h.payload_bytes, c.payload_digest,
  CASE WHEN h.page_id > f.first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN h.page_id > f.first THEN f.first END AS refers_to
FROM hashed h JOIN codes c ON c.hex = h.hex JOIN firsts f ON f.hex = h.hex"""

# CRC-32: the table by its rule, then a byte after another. ``tab`` is a column in reach.
CRC_TABLE = """SELECT list_transform(range(256), lambda n: list_reduce([n, 0, 0, 0, 0, 0, 0, 0, 0],
    lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)) AS tab"""


def crc32(text: str) -> str:
    octets = f"""list_transform(range(octet_length(encode({text}))),
      lambda i: CAST('0x' || substr(hex(encode({text})), 2 * i + 1, 2) AS BIGINT))"""
    steps = f"list_reduce(list_prepend(4294967295, {octets}), lambda c, b: xor(c >> 8, tab[(xor(c, b) & 255) + 1]))"
    return f"xor({steps}, 4294967295)"


CONVERSATION_TRIE = f"""
WITH crc AS ({CRC_TABLE}),
turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
convs AS (
  SELECT c, c - c % 5 AS base, {crc32('CAST(c AS VARCHAR)')} % 9 AS h
  FROM (SELECT DISTINCT conv_id AS c FROM turns), crc),
rebuilt AS (
  SELECT c, 0 AS own, n, role, text FROM convs JOIN turns ON conv_id = base AND n <= h
  UNION ALL SELECT c, 1, n, role, text FROM convs JOIN turns ON conv_id = c AND n > h),
hashed AS (
  SELECT c, row_number() OVER (PARTITION BY c ORDER BY own, n) AS d, strlen(text) AS bytes,
    sha256(length(role) || ':' || role || text) AS id FROM rebuilt),
prefixes AS (
  SELECT c, 0 AS d, '' AS path, 0 AS bytes FROM convs
  UNION ALL SELECT c, d, string_agg(id, '') OVER (PARTITION BY c ORDER BY d), bytes FROM hashed),
nodes AS (
  SELECT path, d, min(c) AS c, count(*) AS n, (count(*) - 1) * max(bytes) AS own, left(path, greatest(d - 1, 0) * 64) AS parent
  FROM prefixes GROUP BY path, d),
children AS (SELECT parent, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY parent),
sums AS (
  SELECT p.path, count(*) FILTER (WHERE k.n_children IS NULL) AS n_leaves, sum(v.own) AS saved
  FROM nodes v LEFT JOIN children k ON k.parent = v.path JOIN prefixes p ON p.c = v.c AND p.d <= v.d GROUP BY p.path),
ends AS (
  SELECT path, sha256(string_agg(CAST(c AS VARCHAR), ',' ORDER BY c)) AS digest
  FROM (SELECT c, arg_max(path, d) AS path FROM prefixes GROUP BY c) GROUP BY path)
SELECT v.c AS conv_id, CAST(v.d AS BIGINT) AS depth, CASE WHEN v.d > 0 THEN u.c END AS parent_conv_id, v.n AS n_convs,
  coalesce(k.n_children, 0) AS n_children, s.n_leaves, CAST(s.saved AS BIGINT) AS saved_tokens,
  coalesce(e.digest, sha256('')) AS ends_sha256
FROM nodes v LEFT JOIN nodes u ON u.path = v.parent AND u.d = v.d - 1 LEFT JOIN children k ON k.parent = v.path
JOIN sums s ON s.path = v.path LEFT JOIN ends e ON e.path = v.path"""

# Near words share what is left without one letter: at the same place, or as a whole word.
SPELLING_VARIANTS = f"""
WITH RECURSIVE crc AS ({CRC_TABLE}),
found AS (
  SELECT doc_id, run, count(*) AS n
  FROM (SELECT doc_id, unnest(regexp_extract_all({ascii_lower("coalesce(text, '')")}, '[A-Za-z\\x{{C0}}-\\x{{FF}}]+')) AS run FROM documents)
  WHERE length(run) >= 6 GROUP BY doc_id, run),
marked AS (SELECT run, n, {crc32("concat(doc_id, ':', run)")} AS h FROM found, crc),
worn AS (
  SELECT CASE WHEN h % 199 = 0 THEN left(run, h % length(run)) || substr(run, h % length(run) + 2) ELSE run END AS word, n FROM marked),
words AS (SELECT word, CAST(sum(n) AS BIGINT) AS n FROM worn WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (
  SELECT word, i, left(word, i) || substr(word, i + 2) AS rest
  FROM (SELECT word, unnest(range(length(word))) AS i FROM words)),
near AS (
  SELECT a.word, b.word AS other FROM less a JOIN less b ON b.rest = a.rest AND b.i = a.i AND b.word <> a.word
  UNION SELECT l.word, w.word FROM less l JOIN words w ON w.word = l.rest
  UNION SELECT w.word, l.word FROM less l JOIN words w ON w.word = l.rest),
ranked AS (
  SELECT a.word, a.other, w.n AS other_n, count(*) OVER (PARTITION BY a.word) AS n_near,
    row_number() OVER (PARTITION BY a.word ORDER BY w.n DESC, a.other) AS place
  FROM near a JOIN words w ON w.word = a.other),
formed AS (
  SELECT w.word, w.n, coalesce(r.n_near, 0) AS n_near, CASE WHEN r.other_n >= 5 * w.n THEN r.other END AS form,
    CASE WHEN r.other_n >= 5 * w.n THEN r.other_n END AS form_n
  FROM words w LEFT JOIN ranked r ON r.word = w.word AND r.place = 1),
ways AS (
  SELECT word, word AS end_word, 0 AS steps FROM words
  UNION ALL SELECT w.word, f.form, w.steps + 1 FROM ways w JOIN formed f ON f.word = w.end_word WHERE f.form IS NOT NULL),
ends AS (SELECT word, arg_max(end_word, steps) AS root FROM ways GROUP BY word)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM formed f JOIN ends e ON e.word = f.word"""

ORACLES = {
    "op6_warc": WARC,
    "op7_decontaminate": DECONTAMINATE,
    "op9_ngram_join": NGRAM_JOIN,
    "op10_line_dedup": LINE_DEDUP,
    "op12_conversation_trie": CONVERSATION_TRIE,
    "op13_spelling_variants": SPELLING_VARIANTS,
}
