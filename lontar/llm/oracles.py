"""DuckDB statements that must give the same rows as the queries of their names."""

_WORDS = r"regexp_extract_all(lower(text), '[\p{L}\p{N}_]+')"

_P8 = rf"""
WITH d AS (SELECT doc_id, {_WORDS} AS w FROM documents WHERE text IS NOT NULL),
i AS (SELECT item_id, {_WORDS} AS w FROM benchmark WHERE text IS NOT NULL),
ig AS (SELECT DISTINCT item_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT item_id, w, unnest(generate_series(1, len(w) - 11)) AS k FROM i WHERE len(w) >= 12)),
dg AS (SELECT doc_id, array_to_string(w[k:k + 11], ' ') AS g FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 11)) AS k FROM d WHERE len(w) >= 12))
SELECT DISTINCT dg.doc_id, ig.item_id FROM dg JOIN ig USING (g)
"""

_P10 = """
WITH w AS (SELECT DISTINCT doc_id, substring(text, k, 240) AS s FROM (SELECT doc_id, text, unnest(generate_series(1, length(text) - 239)) AS k FROM documents WHERE length(text) >= 240)),
m AS (SELECT s FROM w GROUP BY s HAVING count(*) > 1),
v AS (SELECT doc_id, s FROM w SEMI JOIN m USING (s))
SELECT DISTINCT a.doc_id AS doc_id_a, b.doc_id AS doc_id_b FROM v a JOIN v b ON a.s = b.s AND a.doc_id < b.doc_id
"""

_SPACE = r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"

_P7 = rf"""
WITH r AS (SELECT batch_no::INT AS batch, id, source_url, text FROM incoming_articles UNION ALL SELECT 0, NULL, source_url, text FROM news_articles),
u AS (SELECT batch, id, regexp_replace(regexp_replace(trim(source_url), '#.*$', ''), '^[A-Za-z][A-Za-z0-9+.-]*://', '') AS u FROM r WHERE source_url IS NOT NULL),
n AS (SELECT batch, id, regexp_replace(lower(regexp_extract(u, '^[^/?]*')), '^www\.', '') AS host, regexp_replace(regexp_extract(u, '^[^/?]*([^?]*)', 1), '/+$', '') AS path,
  array_to_string(list_filter(string_split(regexp_extract(u, '\?(.*)$', 1), '&'), lambda p: p <> '' AND NOT regexp_matches(lower(p), '^(utm_[^=]*|fbclid|gclid)(=|$)')), '&') AS q FROM u),
a AS (SELECT batch, id, host || path || CASE WHEN q = '' THEN '' ELSE '?' || q END AS v FROM n WHERE host <> ''),
by_url AS (SELECT a.id FROM a JOIN (SELECT v, min(batch) AS b FROM a GROUP BY v) f USING (v) WHERE a.batch > 0 AND f.b < a.batch),
h AS (SELECT batch, id, trim(regexp_replace(regexp_replace(lower(text), '{_SPACE}+', ' ', 'g'), '[^\p{{L}}\p{{N}}_ ]', '', 'g'), ' ') AS t FROM r WHERE text IS NOT NULL),
e AS (SELECT batch, id, sha256(t) AS v FROM h WHERE t <> ''),
k AS (SELECT v, min(batch) AS b FROM (SELECT v, batch FROM e UNION ALL SELECT exact_hash, 0 FROM deduplication_index WHERE exact_hash IS NOT NULL) GROUP BY v),
by_hash AS (SELECT e.id FROM e JOIN k USING (v) WHERE e.batch > 0 AND k.b < e.batch),
x AS (SELECT text, min(batch) AS first, max(batch) AS last, dense_rank() OVER (ORDER BY text) AS no FROM r WHERE text IS NOT NULL GROUP BY text),
w AS (SELECT no, {_WORDS} AS w FROM x),
t AS (SELECT DISTINCT no, w[j] || ' ' || w[j + 1] || ' ' || w[j + 2] AS g FROM (SELECT no, w, unnest(generate_series(1, len(w) - 2)) AS j FROM w WHERE len(w) >= 3)),
s AS (SELECT no, count(*) AS n FROM t GROUP BY no),
c AS (SELECT p.no AS p, q.no AS q, count(*) AS common FROM t p JOIN x px ON px.no = p.no AND px.last > 0 JOIN t q ON q.g = p.g GROUP BY ALL),
l AS (SELECT c.p, min(y.first) AS b FROM c JOIN s sp ON sp.no = c.p JOIN s sq ON sq.no = c.q JOIN x y ON y.no = c.q WHERE c.common >= 0.6 * (sp.n + sq.n - c.common) - 1e-9 GROUP BY c.p),
by_text AS (SELECT r.id FROM r JOIN x ON x.text = r.text JOIN l ON l.p = x.no WHERE r.batch > 0 AND l.b < r.batch)
SELECT DISTINCT id FROM (SELECT id FROM by_url UNION ALL SELECT id FROM by_hash UNION ALL SELECT id FROM by_text) WHERE id IS NOT NULL
"""

ORACLES: dict[str, str] = {"p7_found": _P7, "p8_found": _P8, "p10_found": _P10}
