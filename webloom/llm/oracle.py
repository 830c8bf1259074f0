"""DuckDB SQL of the queries that SQL can express. Chat windows (a greedy
choice), BPE, trained scores, the seeded shuffle and the fuzzy operators are
tested against brute force instead."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

ORACLE = {
    "op3_decontaminate": f"""
WITH items AS (SELECT item_id, {_WORDS} AS w FROM benchmark),
windows AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS size, array_to_string(w[p:p + 9], ' ') AS win
  FROM items, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS t(p) WHERE len(w) > 0),
docs AS (SELECT doc_id, {_WORDS} AS w FROM documents),
places AS (
  SELECT doc_id, s.size, p, array_to_string(w[p:p + s.size - 1], ' ') AS win
  FROM docs, (SELECT DISTINCT size FROM windows) s, unnest(range(1, greatest(len(w) - s.size + 2, 1))) AS t(p)),
hits AS (SELECT doc_id, p, windows.size, item_id FROM places JOIN windows USING (size, win)),
covered AS (
  SELECT doc_id, count(DISTINCT q) AS n_hit
  FROM (SELECT DISTINCT doc_id, p, size FROM hits), unnest(range(p, p + size)) AS t(q) GROUP BY doc_id),
named AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM hits) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
  CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(items, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AS contaminated
FROM docs LEFT JOIN covered USING (doc_id) LEFT JOIN named USING (doc_id)""",
    "op6_warc": """
WITH p AS (
  SELECT page_id, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
k AS (SELECT payload_digest, max(page_id) AS keep FROM p WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN keep <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN keep <> page_id THEN keep END AS refers_to, true AS complete
FROM p LEFT JOIN k USING (payload_digest)""",
    "op9_exact_dedup": """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t
  FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept,
  sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""",
    # The article of these pages is one element without boilerplate inside; its parts are p and h1.
    "op10_html_text": r"""
WITH a AS (
  SELECT page_id, url, regexp_extract(coalesce(html, ''), '(?s)<article>(.*?)</article>', 1) AS body FROM pages),
t AS (
  SELECT page_id, url, regexp_replace(regexp_replace(body, '</?(p|h1|br)[^>]*>', ' ', 'g'), '<[^>]*>', '', 'g') AS t FROM a),
u AS (
  SELECT page_id, url, replace(replace(replace(replace(t, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&') AS t
  FROM t),
v AS (SELECT page_id, url, trim(regexp_replace(t, '\s+', ' ', 'g')) AS text FROM u)
SELECT page_id, url, text, CAST(length(text) AS BIGINT) AS n_chars FROM v""",
    "op11_divergence": r"""
WITH d AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
      '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents),
t AS (SELECT id, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
n AS (SELECT lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
g AS (
  SELECT lang, source, coalesce(total, 0) AS total, coalesce(v, 0) AS v
  FROM (SELECT DISTINCT lang, source FROM d)
  LEFT JOIN (SELECT lang, source, sum(n) AS total FROM n GROUP BY ALL) USING (lang, source) LEFT JOIN v USING (lang)),
p AS (
  SELECT lang, source, term, coalesce(n, 0) AS n, 1 + (1000000000 * (coalesce(n, 0) + 2)) // (total + 2 * v) AS p
  FROM g JOIN kept USING (lang) LEFT JOIN n USING (lang, source, term)),
l AS (
  SELECT lang, term, 1 + (1000000000 * (n + 2)) // (total + 2 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM n GROUP BY ALL) JOIN (SELECT lang, sum(total) AS total, any_value(v) AS v FROM g GROUP BY lang) USING (lang)),
pairs AS (
  SELECT x.lang, x.source, 'pair' AS part, y.source AS item,
    coalesce(sum(((a.p - b.p) * (a.p - b.p)) // (a.p + b.p)), 0) AS value
  FROM g x JOIN g y ON x.lang = y.lang AND x.source <> y.source
  LEFT JOIN p a ON a.lang = x.lang AND a.source = x.source
  LEFT JOIN p b ON b.lang = y.lang AND b.source = y.source AND b.term = a.term
  GROUP BY x.lang, x.source, y.source),
terms AS (
  SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q)) // (p + q) AS value
  FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10""",
    "op13_hard_negatives": """
WITH v AS (
  SELECT row_number() OVER () AS uid, vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda c: floor(256 * CAST(c AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0),
s AS (
  SELECT a.uid AS anchor, a.vec_id AS anchor_id, a.label = c.label AS same, c.uid, c.vec_id,
    CAST(list_inner_product(a.x, c.x) AS BIGINT) AS score
  FROM v a JOIN v c ON a.uid <> c.uid WHERE a.vec_id % 50 = 0),
p AS (
  SELECT *, row_number() OVER (PARTITION BY anchor ORDER BY score DESC, vec_id, uid) AS nth FROM s WHERE same
  QUALIFY nth <= 5),
r AS (
  SELECT p.anchor_id, p.vec_id AS positive_id, p.score AS positive_score, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor, p.nth ORDER BY s.score DESC, s.vec_id, s.uid) AS rank
  FROM p JOIN s ON s.anchor = p.anchor AND NOT s.same
    AND 50 * p.score <= 100 * s.score AND 100 * s.score <= 95 * p.score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM r WHERE rank <= 3""",
}
