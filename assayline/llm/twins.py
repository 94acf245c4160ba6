"""SQL of the queries that SQL can express."""

from __future__ import annotations

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"


def _crc32(text: str) -> str:
    """Unsigned CRC-32 of the UTF-8 bytes of a text, bit by bit."""
    octets = f"list_transform(range(1, octet_length(encode({text})) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::BIGINT)"
    octet = "list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]), lambda x, y: xor(x >> 1, (x & 1) * 3988292384))"
    return f"xor(4294967295::BIGINT, list_reduce(list_prepend(4294967295::BIGINT, {octets}), lambda c, b: {octet}))"


NGRAM_JOIN = f"""
WITH RECURSIVE split AS (
  SELECT doc_id, regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[^\\x20\\x09-\\x0D]+') AS w FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN []::VARCHAR[] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' '))) END AS s FROM split
), grams AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets
), links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM grams a JOIN grams b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
), reach AS (
  SELECT DISTINCT x, x AS y FROM links UNION SELECT r.x, l.y FROM reach r JOIN links l ON r.y = l.x
), least AS (
  SELECT x, min(y) AS m FROM reach GROUP BY x
)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, coalesce(l.m, s.doc_id) AS component_id FROM sets s LEFT JOIN least l ON l.x = s.doc_id
"""


def _field(value: str) -> str:
    return f"coalesce(octet_length(encode({value}::VARCHAR))::VARCHAR || ':' || {value}::VARCHAR, '-')"


def _leaf(text: str) -> str:
    return "sha256(" + " || ".join(_field(v) for v in ("doc_id", "source", "lang", "n_chars", text)) + ")"


MERKLE = f"""
WITH RECURSIVE leaves AS (
  SELECT *, row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS i
  FROM (SELECT doc_id, source, {_leaf("text")} AS leaf, CASE WHEN {_crc32("doc_id::VARCHAR")} % 5 = 0 THEN {_leaf(_LOWER.format("text"))} END AS changed FROM documents)
), low(g, level, i, h) AS (
  SELECT source, 0, i, leaf FROM leaves
  UNION ALL
  SELECT g, level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER (PARTITION BY g) AS n FROM low) WHERE n > 1 GROUP BY g, level, i // 16
), subroots AS (
  SELECT *, row_number() OVER (ORDER BY g NULLS FIRST) - 1 AS i FROM (SELECT g, max(level) AS height, arg_max(h, level) AS h FROM low GROUP BY g)
), high(level, i, h) AS (
  SELECT 0, i, h FROM subroots
  UNION ALL
  SELECT level + 1, i // 16, sha256(string_agg(h, '' ORDER BY i)) FROM (SELECT *, count(*) OVER () AS n FROM high) WHERE n > 1 GROUP BY level, i // 16
), top AS (
  SELECT max(level) AS height, arg_max(h, level) AS root FROM high
), runs AS (
  SELECT g, 0 AS part, level, i // 16 AS run, list(h ORDER BY i) AS hs FROM low GROUP BY ALL
  UNION ALL
  SELECT NULL, 1, level, i // 16, list(h ORDER BY i) FROM high GROUP BY ALL
), steps AS (
  SELECT l.source, l.i, u.step, r.hs, u.own % 16 AS pos
  FROM leaves l JOIN subroots s ON s.g IS NOT DISTINCT FROM l.source CROSS JOIN top t,
    LATERAL (
      SELECT k AS step, 0 AS part, k AS level, l.i // (16 ** k)::BIGINT AS own FROM range(0, s.height) x(k)
      UNION ALL
      SELECT s.height + k, 1, k, s.i // (16 ** k)::BIGINT FROM range(0, t.height) x(k)
    ) u
    JOIN runs r ON r.part = u.part AND r.level = u.level AND r.run = u.own // 16 AND (u.part = 1 OR r.g IS NOT DISTINCT FROM l.source)
), proof AS (
  SELECT source, i, sha256(string_agg(array_to_string(list_concat(list_slice(hs, 1, pos), list_slice(hs, pos + 2, 16)), ''), '' ORDER BY step)) AS p, max(step) AS last FROM steps GROUP BY source, i
), fold(source, i, step, h) AS (
  SELECT source, i, 0, coalesce(changed, leaf) FROM leaves
  UNION ALL
  SELECT f.source, f.i, f.step + 1, sha256(array_to_string(list_concat(list_concat(list_slice(s.hs, 1, s.pos), [f.h]), list_slice(s.hs, s.pos + 2, 16)), ''))
  FROM fold f JOIN steps s ON s.source IS NOT DISTINCT FROM f.source AND s.i = f.i AND s.step = f.step
), ends AS (
  SELECT source, i, arg_max(h, step) AS h FROM fold GROUP BY source, i
)
SELECT l.doc_id, l.leaf, s.h AS subroot, t.root, coalesce(p.p, sha256('')) AS proof_sha256, e.h AS folded_root, e.h = t.root AS verified
FROM leaves l JOIN subroots s ON s.g IS NOT DISTINCT FROM l.source CROSS JOIN top t
  JOIN ends e ON e.source IS NOT DISTINCT FROM l.source AND e.i = l.i LEFT JOIN proof p ON p.source IS NOT DISTINCT FROM l.source AND p.i = l.i
"""

SPELLING = f"""
WITH RECURSIVE runs AS (
  SELECT doc_id, w, length(w) AS len, count(*) AS k
  FROM (SELECT doc_id, unnest(regexp_extract_all({_LOWER.format("coalesce(text, '')")}, '[a-zÀ-ÿ]+')) AS w FROM documents)
  WHERE length(w) >= 5 GROUP BY doc_id, w
), hashed AS (
  SELECT w, len, k, {_crc32("(doc_id::VARCHAR || ':' || w)")} AS h FROM runs
), kept AS (
  SELECT CASE WHEN h % 97 = 0 THEN substr(w, 1, h % len) || substr(w, h % len + 2) ELSE w END AS word, k FROM hashed
), words AS (
  SELECT word, sum(k)::BIGINT AS n FROM kept WHERE length(word) >= 5 GROUP BY word HAVING sum(k) >= 3
), cut AS (
  SELECT DISTINCT word, n, i, substr(word, 1, i) AS a, substr(word, i + 2) AS b FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)
), pairs AS (
  SELECT x.word, x.n, y.word AS other, y.n AS other_n FROM cut x JOIN cut y ON x.i = y.i AND x.a = y.a AND x.b = y.b AND x.word <> y.word
  UNION SELECT c.word, c.n, w.word, w.n FROM cut c JOIN words w ON w.word = c.a || c.b
  UNION SELECT w.word, w.n, c.word, c.n FROM cut c JOIN words w ON w.word = c.a || c.b
), best AS (
  SELECT word, count(*) AS n_near, first(other ORDER BY other_n DESC, encode(other)) AS other, max(other_n) AS other_n FROM pairs GROUP BY word
), forms AS (
  SELECT w.word, w.n, coalesce(b.n_near, 0) AS n_near, CASE WHEN b.other_n >= 2 * w.n THEN b.other END AS form, CASE WHEN b.other_n >= 2 * w.n THEN b.other_n END AS form_n
  FROM words w LEFT JOIN best b USING (word)
), walk(word, here, step) AS (
  SELECT word, word, 0 FROM forms UNION ALL SELECT k.word, f.form, k.step + 1 FROM walk k JOIN forms f ON f.word = k.here WHERE f.form IS NOT NULL
), ends AS (
  SELECT word, arg_max(here, step) AS root FROM walk GROUP BY word
)
SELECT f.word, f.form, e.root, f.n, f.n_near, f.form_n FROM forms f JOIN ends e USING (word)
"""
