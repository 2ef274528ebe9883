"""DuckDB SQL of those queries of this package that SQL can express."""

from __future__ import annotations

from courtline.llm.url_reputation import SUFFIXES

OP6_EXACT_DEDUP = """
WITH d AS (SELECT doc_id, coalesce(text, '') AS text FROM documents),
g AS (SELECT text, max(doc_id) AS keep_id, count(*) AS group_size FROM d GROUP BY text)
SELECT d.doc_id, g.keep_id, g.group_size,
       d.doc_id IS NOT DISTINCT FROM g.keep_id AS kept, sha256(d.text) AS text_sha256
FROM d JOIN g ON d.text = g.text
"""

_SUFFIXES = ", ".join(f"'{s}'" for s in SUFFIXES)

OP3_HOST_REPUTATION = f"""
WITH p AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 1, 's'),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '^.*?://([^/?#]*)([^?#]*)', 2, 's') AS path
  FROM pages),
o AS (
  SELECT doc_id, min(CASE WHEN quality = 1 AND coalesce(toxic, 0) = 0 THEN 1 WHEN quality IS NOT NULL OR coalesce(toxic, 0) <> 0 THEN 0 END) AS good
  FROM labels GROUP BY doc_id),
n AS (
  SELECT *, string_split(regexp_extract(host, '^(?:.*@)?(.*?)\\.?(?::[0-9]*)?$', 1, 's'), '.') AS labels,
         array_to_string(labels[-2:], '.') IN ({_SUFFIXES}) AS two
  FROM p),
h AS (
  SELECT host, array_to_string(labels[CASE WHEN two THEN -3 ELSE -2 END:], '.') AS domain,
         array_to_string(labels[CASE WHEN two THEN -2 ELSE -1 END:], '.') AS suffix,
         count(good) AS n, coalesce(sum(good), 0) AS good
  FROM n LEFT JOIN o ON n.page_id = o.doc_id GROUP BY host, domain, suffix),
d AS (SELECT domain, any_value(suffix) AS suffix, sum(n) AS n, sum(good) AS good FROM h GROUP BY domain),
s AS (SELECT suffix, sum(n) AS n, sum(good) AS good FROM d GROUP BY suffix),
sums AS (
  SELECT lvl, count(*) AS k, sum(n)::DOUBLE AS n, sum(good)::DOUBLE AS good,
         sum(good::DOUBLE * good / n) AS squares, sum(n::DOUBLE * n) AS nn
  FROM (SELECT 'h' AS lvl, n, good FROM h UNION ALL SELECT 'd', n, good FROM d UNION ALL SELECT 's', n, good FROM s)
  WHERE n > 0 GROUP BY lvl),
moments AS (
  SELECT lvl, k, (good + 0.5) / (n + 1.0) AS mean, squares - good * good / n AS spread, n - nn / n - (k - 1) AS room FROM sums),
priors AS (
  SELECT lvl, mean, CASE WHEN mean * (1 - mean) * room > 0 AND spread > mean * (1 - mean) * (k - 1)
    THEN least(1000.0, greatest(1.0, mean * (1 - mean) * room / (spread - mean * (1 - mean) * (k - 1)) - 1)) ELSE 1000.0 END AS m
  FROM moments),
q AS (
  SELECT coalesce(max(mean) FILTER (lvl = 's'), 0.5) AS mean, coalesce(max(m) FILTER (lvl = 's'), 1.0) AS ms,
         coalesce(max(m) FILTER (lvl = 'd'), 1.0) AS md, coalesce(max(m) FILTER (lvl = 'h'), 1.0) AS mh FROM priors),
rs AS (SELECT suffix, (good + ms * mean) / (n + ms) AS rate FROM s, q),
rd AS (SELECT d.domain, (d.good + md * rs.rate) / (d.n + md) AS rate FROM d JOIN rs USING (suffix), q),
rh AS (SELECT h.host, h.n, (h.good + mh * rd.rate) / (h.n + mh) AS rate, mh FROM h JOIN rd USING (domain), q),
v AS (SELECT host, CASE WHEN rate + 1.645 * sqrt(rate * (1 - rate) / (n + mh + 1)) < 0.5 THEN 'block' ELSE 'allow' END AS method FROM rh),
r AS (
  SELECT page_id, p.host, path, method,
    CASE WHEN (p.host = 'www.example.com' OR suffix(p.host, '.www.example.com')) AND prefix(path, '/en/') THEN 'www.example.com/en/'
         WHEN (p.host = 'example.com' OR suffix(p.host, '.example.com')) AND prefix(path, '/en/') THEN 'example.com/en/'
         WHEN (p.host = 'net' OR suffix(p.host, '.net')) AND prefix(path, '/es/') THEN 'net/es/'
         WHEN (p.host = 'net' OR suffix(p.host, '.net')) AND prefix(path, '/fr/') THEN 'net/fr/'
         WHEN (p.host = 'com' OR suffix(p.host, '.com')) AND prefix(path, '/') THEN 'com/' END AS rule
  FROM p JOIN v USING (host))
SELECT page_id, host, path, rule,
  CASE WHEN rule IS NULL THEN method WHEN rule IN ('com/', 'www.example.com/en/') THEN 'allow' ELSE 'block' END AS verdict
FROM r
"""

OP12_HARD_NEGATIVES = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS x
  FROM embeddings
  WHERE label IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, r.vec_id AS other_id, a.label = r.label AS same, list_dot_product(a.x, r.x)::BIGINT AS score
  FROM v a, v r WHERE a.vec_id % 50 = 0 AND a.vec_id <> r.vec_id),
p AS (
  SELECT anchor_id, other_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, other_id) <= 5)
SELECT anchor_id, positive_id,
       (row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, other_id))::INTEGER AS rank,
       other_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 50 * positive_score <= 100 * score AND 100 * score <= 95 * positive_score
QUALIFY rank <= 3
"""


def oracle_sql() -> dict[str, str]:
    return {
        "op3_host_reputation": OP3_HOST_REPUTATION,
        "op6_exact_dedup": OP6_EXACT_DEDUP,
        "op12_hard_negatives": OP12_HARD_NEGATIVES,
    }
