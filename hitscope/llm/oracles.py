"""DuckDB SQL for the registered queries: brute force, no sketches, filters
or hashes, and constants of its own."""

_LOW = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_PLAIN = rf"regexp_extract_all({_LOW}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"
_SPACED = rf"regexp_extract_all({_LOW}, '[^\x20\x09-\x0D]+')"

_BAD = "'^(utm_[^=]*|ref|fbclid|gclid|msclkid)(=.*)?$'"

SQL = {
    "op1_url_filter": f"""
WITH p AS (
  SELECT page_id, url, CASE WHEN contains(url, '://') THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
),
q AS (
  SELECT page_id, url, regexp_extract(rest, '^[^/?#]*') AS h0, regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path,
         list_sort(list_filter(string_split(regexp_extract(rest, '^[^?#]*[?]([^#]*)', 1), '&'),
                               lambda x : x <> '' AND NOT regexp_matches(x, {_BAD}))) AS args
  FROM p
),
h AS (SELECT *, translate(h0, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host FROM q),
c AS (
  SELECT *, CASE WHEN contains(url, '://') THEN
    regexp_replace(regexp_replace(host, '[.]?(:80|:443)?$', ''), '^www[.]', '') || rtrim(path, '/')
    || CASE WHEN len(args) > 0 THEN '?' || array_to_string(args, '&') ELSE '' END END AS canon
  FROM h
),
listed AS (SELECT DISTINCT canon FROM c WHERE page_id % 50 = 0 AND canon IS NOT NULL),
j AS (
  SELECT page_id, host, path, canon,
    CASE WHEN (host = 'example.com' OR host LIKE '%.example.com') AND path LIKE '/de/%' THEN 'example.com/de/'
         WHEN (host = 'example.net' OR host LIKE '%.example.net') AND path LIKE '/en/%' THEN 'example.net/en/'
         WHEN (host = 'org' OR host LIKE '%.org') AND path LIKE '/fr/%' THEN 'org/fr/'
         WHEN (host = 'net' OR host LIKE '%.net') AND path LIKE '/%' THEN 'net/' END AS rule
  FROM c
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
       WHEN canon IN (SELECT canon FROM listed) THEN 'block' ELSE 'allow' END AS verdict,
  CASE WHEN rule IS NULL THEN coalesce(canon IN (SELECT canon FROM listed), false) END AS listed
FROM j""",
    "op2_line_dedup": """
WITH a AS (SELECT row_number() OVER () AS r, doc_id, source, text, string_split(text, chr(10)) AS raw FROM documents),
d AS (SELECT *, list_transform(raw, lambda x : trim(x, chr(32) || chr(9) || chr(13) || chr(11) || chr(12))) AS ls FROM a),
l AS (SELECT r, source, i, raw[i] AS raw_line, ls[i] AS line FROM (SELECT *, unnest(range(1, len(ls) + 1)) AS i FROM d)),
spread AS (SELECT line FROM l WHERE line <> '' GROUP BY line HAVING count(DISTINCT source) >= 5),
body AS (
  SELECT r, source, list(line ORDER BY i) FILTER (WHERE spread.line IS NULL) AS own
  FROM l LEFT JOIN spread USING (line) WHERE line <> '' GROUP BY r, source
  HAVING 5 * coalesce(sum(length(line)) FILTER (WHERE spread.line IS NULL), 0) >= sum(length(line))
),
b AS (
  SELECT line FROM l JOIN spread USING (line) JOIN body USING (r)
  GROUP BY line HAVING count(DISTINCT body.source) >= 5 AND count(DISTINCT own) >= 5
),
k AS (
  SELECT r, string_agg(raw_line, chr(10) ORDER BY i) FILTER (WHERE b.line IS NULL) AS text, count(b.line) AS gone
  FROM l LEFT JOIN b USING (line) GROUP BY r
)
SELECT doc_id, CASE WHEN d.text IS NOT NULL THEN coalesce(k.text, '') END AS text, coalesce(len(raw), 0) AS n_lines, coalesce(gone, 0) AS n_removed
FROM d LEFT JOIN k USING (r)""",
    "op4_license_scan": f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS text, {_PLAIN} AS w FROM documents),
ph(phrase, label) AS (VALUES ('cc by', 'cc-by'), ('general public license', 'gpl'), ('all rights reserved', 'reserved')),
places AS (
  SELECT r, j - 1 AS j, label
  FROM (SELECT r, w, unnest(range(1, len(w) + 1)) AS j FROM d) x JOIN ph
    ON array_to_string(w[j : j + len(string_split(phrase, ' ')) - 1], ' ') = phrase
),
base AS (SELECT r, count(*) AS n, min(j) AS lo, max(j) AS hi, list(DISTINCT label) AS labels FROM places GROUP BY r),
tp(label, sentence) AS (VALUES
  ('apache-2.0', 'licensed under the apache license version 2 0'),
  ('bsd', 'redistribution and use in source and binary forms with or without modification are permitted'),
  ('cc-by-4.0', 'licensed under a creative commons attribution 4 0 international license'),
  ('cc-by-nc-4.0', 'licensed under cc by nc 4 0'),
  ('gpl-3.0', 'this work is licensed under the gnu general public license version 3'),
  ('mit', 'released under the mit license'),
  ('mit', 'permission is hereby granted free of charge to any person obtaining a copy of this software'),
  ('mpl-2.0', 'this source code form is subject to the terms of the mozilla public license v 2 0')),
t AS (SELECT label, list_distinct(string_split(sentence, ' ')) AS ws, len(string_split(sentence, ' ')) AS n FROM tp),
bl AS (SELECT r, {_PLAIN} AS bw FROM (SELECT r, unnest(string_split(text, chr(10))) AS text FROM d)),
spans AS (
  SELECT r, label, ws, w[j : j + n - 1] AS bw
  FROM (SELECT r, label, ws, n, w, unnest(range(1, greatest(len(w) - n + 1, 1) + 1)) AS j
        FROM d, t WHERE len(list_intersect(ws, w)) >= ceil(0.8 * len(ws) - 1e-9))
),
held AS (
  SELECT r, label, len(ws) AS size, len(list_intersect(ws, bw)) AS n FROM bl, t WHERE list_has_any(bw, ws)
  UNION ALL SELECT r, label, len(ws), len(list_intersect(ws, bw)) FROM spans
),
met AS (SELECT r, label, n / size AS share FROM held WHERE n >= ceil(0.8 * size - 1e-9)),
m AS (SELECT r, list(DISTINCT label) AS labels, max(share) AS best FROM met GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n, 0) AS n_base, lo AS first_word, hi AS last_word,
  coalesce(array_to_string(list_sort(base.labels), ','), '') AS base_labels,
  coalesce(array_to_string(list_sort(list_distinct(list_concat(coalesce(base.labels, []), coalesce(m.labels, [])))), ','), '') AS labels,
  CASE WHEN n > 0 THEN 1.0 ELSE coalesce(best, 0.0) END AS score
FROM d LEFT JOIN base USING (r) LEFT JOIN m USING (r)""",
    "op8_warc": """
WITH p AS (SELECT page_id, url, encode(coalesce(html, '')) AS b FROM pages),
q AS (SELECT page_id, url, CAST(octet_length(b) AS BIGINT) AS n, sha1(b) AS d FROM p),
g AS (SELECT d, max(page_id) AS head FROM q WHERE n >= 1000 GROUP BY d)
SELECT page_id, n AS payload_bytes, d AS payload_digest,
       CASE WHEN head IS NULL OR head = page_id THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN head <> page_id THEN head END AS refers_to, url AS target_uri
FROM q LEFT JOIN g USING (d)""",
    "op9_decontaminate": f"""
WITH d AS (SELECT doc_id, {_PLAIN} AS w FROM documents),
i AS (SELECT CAST(item_id AS VARCHAR) AS item, {_PLAIN} AS w FROM benchmark),
g AS (
  SELECT DISTINCT item, k, array_to_string(w[j : j + k - 1], ' ') AS gram
  FROM (SELECT item, w, least(10, len(w)) AS k, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS j FROM i WHERE len(w) > 0)
),
dw AS (
  SELECT doc_id, k, j, array_to_string(w[j : j + k - 1], ' ') AS gram
  FROM (SELECT doc_id, w, k, unnest(range(1, len(w) - k + 2)) AS j
        FROM d, (SELECT DISTINCT k FROM g) WHERE len(w) >= k)
),
hits AS (SELECT doc_id, k, j, item FROM dw JOIN g USING (k, gram)),
cover AS (SELECT doc_id, count(DISTINCT p) AS n FROM (SELECT doc_id, unnest(range(j, j + k)) AS p FROM hits) GROUP BY 1),
its AS (SELECT doc_id, count(DISTINCT item) AS n, string_agg(DISTINCT item, ',' ORDER BY item) AS s FROM hits GROUP BY 1)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(cover.n, 0) AS n_hit, coalesce(its.n, 0) AS n_items,
       sha256(coalesce(its.s, '')) AS items_sha256, coalesce(cover.n, 0) > 0 AS contaminated
FROM d LEFT JOIN cover USING (doc_id) LEFT JOIN its USING (doc_id)""",
    "op10_near_duplicates": f"""
WITH RECURSIVE d AS (SELECT doc_id, {_SPACED} AS w FROM documents),
s AS (
  SELECT DISTINCT doc_id, array_to_string(w[j : j + 4], ' ') AS sh
  FROM (SELECT doc_id, w, unnest(range(1, greatest(len(w) - 4, 1) + 1)) AS j FROM d WHERE len(w) > 0)
),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY 1),
p AS (SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b USING (sh) WHERE a.doc_id < b.doc_id GROUP BY 1, 2),
e AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y WHERE 100 * c >= 85 * (a.n + b.n - c)
),
both_ways AS (SELECT x, y FROM e UNION SELECT y, x FROM e),
reach AS (SELECT x, y FROM both_ways UNION SELECT r.x, b.y FROM reach r JOIN both_ways b ON r.y = b.x),
root AS (SELECT x AS doc_id, min(y) AS m FROM reach GROUP BY 1)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(m, d.doc_id)) AS component_id,
       least(d.doc_id, coalesce(m, d.doc_id)) = d.doc_id AS kept
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN root USING (doc_id)""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x : CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS q
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x : x IS NULL OR NOT isfinite(x))) = 0
),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS other, a.label = b.label AS same,
         CAST(list_sum(list_transform(list_zip(a.q, b.q), lambda z : z[1] * z[2])) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0
),
pos AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other) AS k FROM s WHERE same) WHERE k <= 5
),
neg AS (
  SELECT p.anchor_id, p.other AS positive_id, n.other AS negative_id, p.score AS positive_score, n.score AS negative_score,
         CAST(row_number() OVER (PARTITION BY p.anchor_id, p.other ORDER BY n.score DESC, n.other) AS INTEGER) AS rank
  FROM pos p JOIN s n ON n.anchor_id = p.anchor_id AND NOT n.same
   AND 50 * p.score <= 100 * n.score AND 100 * n.score <= 95 * p.score
)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 3""",
}
