"""DuckDB SQL for the queries that SQL can express on whole tables."""

from __future__ import annotations

URL_PLACE = """
  SELECT page_id, url,
    translate(coalesce(regexp_extract(url, '(?s)^.*?://([^/?#]*)', 1), ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
    coalesce(regexp_extract(url, '(?s)^.*?://[^/?#]*([^?#]*)', 1), '') AS path
  FROM pages
"""

OP9 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS payload_digest,
    octet_length(encode(coalesce(html, ''))) AS payload_bytes
  FROM pages
), w AS (
  SELECT *, max(page_id) OVER (PARTITION BY payload_digest) AS first FROM p
)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
FROM w
"""

OP10 = f"""
WITH p AS ({URL_PLACE}), r AS (
  SELECT *, host || path AS place FROM p
), b AS (
  SELECT *, CASE
    WHEN regexp_matches(place, '^([^/]*\\.)?example\\.com/de/') THEN 'example.com/de/'
    WHEN regexp_matches(place, '^([^/]*\\.)?example\\.net/en/') THEN 'example.net/en/'
    WHEN regexp_matches(place, '^([^/]*\\.)?org/fr/') THEN 'org/fr/'
    WHEN regexp_matches(place, '^([^/]*\\.)?net/') THEN 'net/' END AS rule,
    regexp_matches(place, '^([^/]*\\.)?doubleclick\\.[a-z]+/|^(ads?|adserver|track)\\.')
      OR regexp_matches(place, '^[^/]+/(.*/)?(login|signup|checkout)([/.]|$)|^[^/]+/search([/.]|$)') AS own
  FROM r
)
SELECT page_id, host, path, rule,
  CASE WHEN rule IN ('net/', 'example.com/de/') THEN 'block' WHEN rule IS NOT NULL THEN 'allow'
    WHEN own THEN 'block' ELSE 'allow' END AS verdict
FROM b
"""

OP11 = """
WITH v AS (
  SELECT vec_id, CAST(CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS BIGINT) AS label,
    [floor(256 * CAST(y AS DOUBLE)) FOR y IN embedding] AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([y FOR y IN embedding IF y IS NULL OR NOT isfinite(y)]) = 0
), s AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same, CAST(list_dot_product(a.x, c.x) AS BIGINT) AS score
  FROM v AS a JOIN v AS c ON a.vec_id <> c.vec_id AND len(a.x) = len(c.x)
  WHERE a.vec_id % 100 = 0
), p AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
)
SELECT anchor_id, positive_id,
  CAST(row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY score DESC, vec_id) AS INTEGER) AS rank,
  vec_id AS negative_id, positive_score, score AS negative_score
FROM p JOIN s USING (anchor_id)
WHERE NOT same AND 30 * positive_score <= 100 * score AND 100 * score <= 90 * positive_score
QUALIFY rank <= 10
"""

# Each control string in a role or text costs one character more; a turn's marks take 20.
OP13 = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), c AS (
  SELECT *, length(regexp_replace(role, '([<\[])(\\*)(/?s>|/?INST\])', '\1+\2\3', 'g'))
    + length(regexp_replace(text, '([<\[])(\\*)(/?s>|/?INST\])', '\1+\2\3', 'g')) + 20 AS n
  FROM t
), g AS (
  SELECT conv_id, count(*) AS n_turns, sum(n) AS n,
    string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text) AS said,
    coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (WHERE role = 'assistant'), '') AS loss
  FROM c GROUP BY conv_id
)
SELECT CAST(conv_id AS BIGINT) AS conv_id, n_turns, sha256(said) AS turns_sha256, length(loss) AS loss_chars,
  sha256(loss) AS loss_sha256, CAST(n AS BIGINT) AS formatted_chars
FROM g
"""

ORACLES: dict[str, str] = {
    "op9_warc": OP9,
    "op10_url_filter": OP10,
    "op11_hard_negatives": OP11,
    "op13_chat_format": OP13,
}
