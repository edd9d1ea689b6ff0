"""Reference SQL (DuckDB) of the queries it can express, stated from the contracts."""

from __future__ import annotations

from garimpo.llm.mixing import MARKS

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_FOLDED = f"translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}')"

CONTAMINATION = rf"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
),
items AS (
  SELECT CAST(item_id AS VARCHAR) AS item, regexp_extract_all({_FOLDED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM benchmark WHERE item_id IS NOT NULL
),
windows AS (
  SELECT DISTINCT item, n, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT item, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM (SELECT item, w, least(13, len(w)) AS n FROM items WHERE len(w) > 0))
),
places AS (
  SELECT rid, n, i, array_to_string(w[i:i + n - 1], ' ') AS win
  FROM (SELECT rid, w, n, unnest(range(1, len(w) - n + 2)) AS i
        FROM docs, (SELECT DISTINCT n FROM windows) WHERE len(w) >= n)
),
hits AS (SELECT rid, i, p.n, item FROM places p JOIN windows v ON p.n = v.n AND p.win = v.win),
words AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + n)) AS pos FROM hits) GROUP BY rid),
found AS (SELECT rid, count(DISTINCT item) AS n_items, string_agg(DISTINCT item, ',' ORDER BY item) AS list FROM hits GROUP BY rid)
SELECT doc_id, len(w) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(list, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM docs LEFT JOIN words USING (rid) LEFT JOIN found USING (rid)
"""

JACCARD = rf"""
WITH RECURSIVE docs AS (
  SELECT doc_id, regexp_extract_all({_FOLDED}, '[^\x20\x09-\x0D]+') AS w FROM documents
),
shingles AS (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS s
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 1, 2))) AS i FROM docs WHERE len(w) > 0)
),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
pairs AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM shingles x JOIN shingles y ON x.s = y.s AND x.doc_id <> y.doc_id GROUP BY 1, 2
),
links AS (
  SELECT a, b FROM pairs JOIN sizes p ON p.doc_id = a JOIN sizes q ON q.doc_id = b WHERE 100 * c >= 90 * (p.n + q.n - c)
),
reached(doc_id, c) AS (
  SELECT doc_id, doc_id FROM docs UNION SELECT l.b, r.c FROM reached r JOIN links l ON l.a = r.doc_id
)
SELECT d.doc_id, coalesce(any_value(s.n), 0) AS n_shingles, min(r.c) AS component_id
FROM docs d LEFT JOIN sizes s ON s.doc_id = d.doc_id JOIN reached r ON r.doc_id = d.doc_id GROUP BY d.doc_id
"""

SUBSTRINGS = r"""
WITH docs AS (
  SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
),
windows AS (
  SELECT rid, i, md5(array_to_string(w[i:i + 34], ' ')) AS h
  FROM (SELECT rid, w, unnest(range(1, len(w) - 33)) AS i FROM docs WHERE len(w) >= 35)
),
twice AS (SELECT h FROM windows GROUP BY h HAVING count(*) > 1),
gone AS (SELECT DISTINCT rid, unnest(range(i, i + 35)) AS pos FROM windows SEMI JOIN twice USING (h)),
kept AS (
  SELECT rid, string_agg(word, ' ' ORDER BY pos) AS list, count(*) AS n
  FROM (SELECT rid, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS pos FROM docs WHERE len(w) > 0) ANTI JOIN gone USING (rid, pos)
  GROUP BY rid
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(list, '')) AS kept_sha256
FROM docs LEFT JOIN kept USING (rid)
"""

MIXTURE = rf"""
WITH rows AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size, coalesce(text, '') AS text FROM documents
),
keyed AS (
  SELECT doc_id, source, size,
    -ln((('0x' || substr(md5(coalesce(CAST(doc_id AS VARCHAR), '')), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496.0::DOUBLE)
      / ((size + 1)::DOUBLE / (size + 1 + length(text) - length(translate(text, '{MARKS}', '')))::DOUBLE) AS key
  FROM rows
),
sources AS (
  SELECT source, sum(size)::BIGINT AS s, [3.0::DOUBLE, 1.0::DOUBLE, 2.0::DOUBLE][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS w
  FROM keyed GROUP BY source
),
-- Capped sources come first by size over weight; the level is what the rest gets for a weight of 1.
levels AS (
  SELECT s, w, row_number() OVER (ORDER BY s / w, source) AS place,
    (1.5::DOUBLE * (SELECT sum(s) FROM sources) - coalesce(sum(2 * s) OVER before, 0))
      / (sum(w) OVER () - coalesce(sum(w) OVER before, 0)) AS level
  FROM sources WINDOW before AS (ORDER BY s / w, source ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
),
level AS (SELECT coalesce(arg_min(level, place) FILTER (2 * s > level * w), 0) AS v FROM levels),
plan AS (
  SELECT source, s, least((2 * s)::DOUBLE, w * v) AS target,
    CASE WHEN s > 0 THEN floor(least((2 * s)::DOUBLE, w * v) / s)::BIGINT ELSE 0 END AS epochs
  FROM sources, level
),
ranked AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id NULLS LAST, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM keyed
)
SELECT doc_id, size::BIGINT AS size, s AS source_size, target,
  (epochs * size + greatest(0, least(size, floor(target)::BIGINT - epochs * s - before)))::BIGINT AS taken
FROM ranked r JOIN plan p ON r.source IS NOT DISTINCT FROM p.source
"""
