"""SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

_STRETCH = r"""
WITH rec AS (
  SELECT 'page' AS rec, page_uid AS rec_uid, full_text AS t, (SELECT max_size FROM size_limits WHERE field_name = 'journal_pages.full_text') AS m FROM journal_pages
  UNION ALL
  SELECT 'article', article_uid, abstract, (SELECT max_size FROM size_limits WHERE field_name = 'articles.abstract') FROM articles),
cut AS (
  SELECT rec, rec_uid, m, string_split(regexp_replace(regexp_replace(t, '([。！？；!?;\n])', '\1' || chr(1), 'g'), '\.([\s\p{Z}' || chr(11) || '])', '.' || chr(1) || '\1', 'g'), chr(1)) AS parts
  FROM rec WHERE length(t) > m)
SELECT DISTINCT rec, rec_uid, CASE WHEN list_max(list_transform(parts, lambda x: length(x))) > m THEN 'forced' ELSE 'natural' END AS cut FROM cut
"""

_REPEATED = r"""
WITH f AS (
  SELECT DISTINCT id, 'answer' AS field_name, regexp_replace(answer, '[\s\p{Z}' || chr(11) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || ']', '', 'g') AS s FROM samples
  UNION ALL
  SELECT DISTINCT id, 'text', regexp_replace(text, '[\s\p{Z}' || chr(11) || chr(28) || chr(29) || chr(30) || chr(31) || chr(133) || ']', '', 'g') FROM samples)
SELECT id, field_name FROM f
WHERE length(s) - 14 >= 20 AND 1 - list_unique(list_transform(range(1, length(s) - 13), lambda i: substr(s, i, 15)))::DOUBLE / (length(s) - 14) >= 0.3
"""

_PAIRS = r"""
WITH c AS (
  SELECT DISTINCT id, regexp_replace(lower(answer), '[^\p{L}\p{N}_]', '', 'g') AS body, coalesce(regexp_replace(lower(instruction), '[^\p{L}\p{N}_]', '', 'g'), '') AS head FROM samples WHERE answer IS NOT NULL),
d AS (SELECT id, head || body AS t FROM c WHERE length(body) >= 200),
g AS (SELECT id, unnest(list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)))) AS gram FROM d),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
h AS (SELECT g.id, gram, n FROM g JOIN n USING (id)),
o AS (SELECT a.id AS id_a, b.id AS id_b, a.n AS na, b.n AS nb, count(*) AS both_n FROM h a JOIN h b ON a.gram = b.gram AND a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) GROUP BY ALL)
SELECT id_a, id_b FROM o WHERE both_n * 1.8 >= 0.8 * (na + nb) - 1e-9
"""

# Compatibility folding as far as plain SQL can: full-width signs, and the other compatibility signs that the tables hold. Runs of 40 comparable characters that both texts have.
_WIDE = [*range(0xFF10, 0xFF1A), *range(0xFF21, 0xFF3B), *range(0xFF41, 0xFF5B)]
_FULL, _HALF = "".join(map(chr, _WIDE)), "".join(chr(c - 0xFEE0) for c in _WIDE)
_FOLDED = "regexp_replace(lower(translate(replace(replace(replace({}, '\ufb01', 'fi'), '\ufb02', 'fl'), '\u2103', '\u00b0C'), '" + _FULL + "\u00b5\u2126\u00b2\u00b3', '" + _HALF + "\u03bc\u03a923')), '[^\\p{{L}}\\p{{N}}]', '', 'g')"
_LEAKS = f"""
WITH i AS (SELECT item_id, {_FOLDED.format("item_text")} AS c FROM eval_items WHERE item_text IS NOT NULL), d AS (SELECT doc_id, {_FOLDED.format("text")} AS c FROM documents WHERE text IS NOT NULL),
iw AS (SELECT DISTINCT item_id, unnest(list_transform(range(1, length(c) - 38), lambda k: substr(c, k, 40))) AS run FROM i WHERE length(c) >= 40),
dw AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, length(c) - 38), lambda k: substr(c, k, 40))) AS run FROM d WHERE length(c) >= 40)
SELECT DISTINCT doc_id, item_id FROM dw JOIN iw USING (run)"""

_CLASSES = _PAIRS.split("g AS (SELECT id,", 1)[0].replace("WITH c AS", "WITH RECURSIVE c AS") + r"""
t AS (SELECT t, min(id) AS id FROM d GROUP BY t),
g AS (SELECT id, unnest(list_distinct(list_transform(range(1, length(t) - 1), lambda i: substr(t, i, 3)))) AS gram FROM t),
n AS (SELECT id, count(*) AS n FROM g GROUP BY id),
h AS (SELECT g.id, gram, n FROM g JOIN n USING (id)),
o AS (SELECT a.id AS a, b.id AS b, a.n AS na, b.n AS nb, count(*) AS both_n FROM h a JOIN h b ON a.gram = b.gram AND a.id < b.id AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) GROUP BY ALL),
e AS (SELECT a, b FROM o WHERE both_n * 1.8 >= 0.8 * (na + nb) - 1e-9), s AS (SELECT a, b FROM e UNION SELECT b, a FROM e),
r(u, v) AS (SELECT id, id FROM t UNION SELECT r.u, s.b FROM r JOIN s ON s.a = r.v),
k AS (SELECT u, min(v) AS class_id FROM r GROUP BY u), m AS (SELECT a, count(*) AS n_links FROM s GROUP BY a),
w AS (SELECT d.id, t.id AS text_id, class_id, coalesce(n_links, 0) AS n_links FROM (SELECT DISTINCT id, t FROM d) d JOIN t USING (t) JOIN k ON k.u = t.id LEFT JOIN m ON m.a = t.id)
SELECT i.id, text_id, class_id, coalesce(n_links, 0) AS n_links FROM (SELECT DISTINCT id FROM samples) i LEFT JOIN w USING (id)"""

ORACLES: dict[str, str] = {
    "p3_links": _CLASSES,
    "p9_found": _LEAKS,
    "p3_found": _PAIRS,
    "p6_found": _STRETCH,
    "p7_found": _REPEATED,
    "p8_found": "SELECT DISTINCT doc_id FROM documents WHERE text IS NOT NULL AND strlen(text) + 1 > (SELECT max_size FROM size_limits WHERE field_name = 'documents.text')",
}
