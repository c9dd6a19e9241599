"""SQL of training-data operators for an independent engine, written from their contracts: every pair, every window."""

from __future__ import annotations

#: A text with A-Z in lower case.
_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"

#: Sets of four-word shingles, all pairs that share one, links of at least 80 percent, and all that is reachable over links.
NEAR_DUPLICATES = f"""
WITH RECURSIVE words AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^ \\t-\\r]+') AS w FROM documents),
sets AS MATERIALIZED (SELECT doc_id, CASE WHEN len(w) = 0 THEN [] ELSE list_distinct(list_transform(range(1, greatest(len(w) - 4, 0) + 2), lambda i: array_to_string(w[i : i + 3], ' '))) END AS s FROM words),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets),
pairs AS (SELECT a.doc_id AS a, b.doc_id AS b FROM shingles a JOIN shingles b ON a.x = b.x AND a.doc_id < b.doc_id
          GROUP BY 1, 2 HAVING 100 * count(*) >= 80 * (any_value(a.n) + any_value(b.n) - count(*))),
links AS MATERIALIZED (SELECT a, b FROM pairs UNION ALL SELECT b, a FROM pairs),
reached(a, b) AS (SELECT a, b FROM links UNION SELECT r.a, l.b FROM reached r JOIN links l ON l.a = r.b)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(least(s.doc_id, c.least), s.doc_id) AS component_id,
       coalesce(least(s.doc_id, c.least), s.doc_id) = s.doc_id AS kept
FROM sets s LEFT JOIN (SELECT a, min(b) AS least FROM reached GROUP BY 1) c ON c.a = s.doc_id
"""

#: All windows of 13 words (whole items if shorter) of both sides, joined as text.
DECONTAMINATION = f"""
WITH told AS (SELECT doc_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM documents),
items AS (SELECT item_id, regexp_extract_all({_LOWER}, '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+') AS w FROM benchmark),
sized AS (SELECT item_id, w, least(13, len(w)) AS size FROM items WHERE len(w) > 0),
windows AS MATERIALIZED (SELECT DISTINCT item_id, size, array_to_string(w[i : i + size - 1], ' ') AS x FROM (SELECT *, unnest(range(1, len(w) - size + 2)) AS i FROM sized)),
places AS (SELECT doc_id, i, size, array_to_string(w[i : i + size - 1], ' ') AS x
           FROM (SELECT doc_id, w, size, unnest(range(1, len(w) - size + 2)) AS i FROM told, (SELECT DISTINCT size FROM windows) WHERE len(w) >= size)),
found AS MATERIALIZED (SELECT doc_id, i, p.size, item_id FROM places p JOIN windows v ON v.x = p.x AND v.size = p.size),
hit AS (SELECT doc_id, count(DISTINCT place) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + size)) AS place FROM found) GROUP BY 1),
named AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY 1)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n, 0) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM told LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)
"""
