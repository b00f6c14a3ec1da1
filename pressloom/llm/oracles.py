"""SQL of the exact results of operators whose queries need no tokenizer, network or miner: every pair, window and place."""

from __future__ import annotations

import string

#: only A-Z are lower-cased
LOWER = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"

NEAR_DUPLICATES_SQL = rf"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x20\x09-\x0D]+') AS w FROM documents WHERE text IS NOT NULL),
sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, greatest(len(w) - 4, 1) + 1), lambda i: array_to_string(w[i:i + 4], ' ')))) AS s
  FROM words WHERE len(w) > 0),
nodes AS (SELECT row_number() OVER () AS node, s, len(s) AS n, min(doc_id) AS low FROM sets GROUP BY s),
members AS (SELECT node, n, unnest(s) AS shingle FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM members a JOIN members b
    ON a.shingle = b.shingle AND a.node <> b.node AND 100 * least(a.n, b.n) >= 85 * greatest(a.n, b.n)
  GROUP BY a.node, b.node, a.n, b.n HAVING 100 * count(*) >= 85 * (a.n + b.n - count(*))),
reach AS (
  SELECT node, node AS other FROM nodes
  UNION SELECT r.node, l.b FROM reach r JOIN links l ON l.a = r.other),
component AS (SELECT r.node, min(o.low) AS component_id FROM reach r JOIN nodes o ON o.node = r.other GROUP BY r.node)
SELECT d.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, coalesce(c.component_id, d.doc_id) AS component_id,
       coalesce(c.component_id, d.doc_id) IS NOT DISTINCT FROM d.doc_id AS kept
FROM documents d LEFT JOIN sets s ON s.doc_id = d.doc_id LEFT JOIN nodes n ON n.s = s.s LEFT JOIN component c ON c.node = n.node"""

DECONTAMINATION_SQL = rf"""
WITH texts AS (
  SELECT doc_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents WHERE text IS NOT NULL),
items AS (
  SELECT item_id, regexp_extract_all({LOWER}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w, least(len(w), 10) AS n
  FROM benchmark WHERE text IS NOT NULL),
windows AS (
  SELECT DISTINCT item_id, n, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT item_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM items WHERE n > 0)),
grams AS (
  SELECT doc_id, n, i, array_to_string(w[i:i + n - 1], ' ') AS s
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM texts, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)),
found AS (SELECT doc_id, i, g.n, item_id FROM grams g JOIN windows v ON v.n = g.n AND v.s = g.s),
hit AS (
  SELECT doc_id, count(DISTINCT place) AS n_hit
  FROM (SELECT doc_id, unnest(range(i, i + n)) AS place FROM (SELECT DISTINCT doc_id, i, n FROM found)) GROUP BY doc_id),
named AS (SELECT doc_id, list_sort(list(DISTINCT item_id::VARCHAR)) AS items FROM found GROUP BY doc_id)
SELECT d.doc_id, coalesce(len(t.w), 0)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(len(items), 0)::BIGINT AS n_items,
       sha256(coalesce(array_to_string(items, ','), '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM documents d LEFT JOIN texts t USING (doc_id) LEFT JOIN hit USING (doc_id) LEFT JOIN named USING (doc_id)"""

#: bytes as two hexadecimal digits each; places are taken from blocks of 1024, as a substring's cost follows its text's length
REPEATED_STRINGS_SQL = """
WITH texts AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h, (length(h) / 2)::BIGINT AS n FROM documents),
blocks AS (
  SELECT doc_id, n, start, substr(h, 2 * start + 1, 2 * 1423) AS part
  FROM (SELECT doc_id, n, h, unnest(range(0, n - 399, 1024)) AS start FROM texts WHERE n >= 400)),
places AS (
  SELECT doc_id, start + i AS p, md5_number(substr(part, 2 * i + 1, 800)) AS digest
  FROM (SELECT doc_id, start, part, unnest(range(0, least(1024, n - 399 - start))) AS i FROM blocks)),
again AS (
  SELECT doc_id, p FROM places JOIN (SELECT digest FROM places GROUP BY digest HAVING count(*) > 1) USING (digest)),
edges AS (SELECT doc_id, p, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 400, true) AS opens FROM again),
numbered AS (SELECT doc_id, p, sum(opens::INT) OVER (PARTITION BY doc_id ORDER BY p ROWS UNBOUNDED PRECEDING) AS span FROM edges),
spans AS (SELECT doc_id, span, min(p) AS first, max(p) + 400 AS last FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, span, last, substr(h, 2 * last + 1, 2 * (coalesce(lead(first) OVER (PARTITION BY doc_id ORDER BY span), n) - last)) AS after
  FROM spans JOIN texts USING (doc_id)),
kept AS (SELECT doc_id, string_agg(after, '' ORDER BY span) AS after FROM gaps GROUP BY doc_id),
removed AS (SELECT doc_id, sum(last - first) AS n_removed, count(*) AS n_spans, min(first) AS first FROM spans GROUP BY doc_id)
SELECT doc_id, n AS n_bytes, coalesce(n_removed, 0)::BIGINT AS n_removed, coalesce(n_spans, 0)::BIGINT AS n_spans,
       sha256(unhex(CASE WHEN n_spans IS NULL THEN h ELSE substr(h, 1, 2 * first) || after END)) AS kept_sha256
FROM texts LEFT JOIN removed USING (doc_id) LEFT JOIN kept USING (doc_id)"""
