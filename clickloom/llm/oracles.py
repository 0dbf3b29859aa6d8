"""The queries that SQL can express, in DuckDB SQL."""

from __future__ import annotations

# Shares of four sources in the mix; the other sources share the rest in their own proportions.
TARGETS = {"src0": 0.2, "src1": 0.1, "src2": 0.1, "src3": 0.1}
SEED = "mix-1"

ORACLES: dict[str, str] = {}


def mixed_sources(docs: str, targets: dict[str, float], seed: str) -> str:
    """CTEs that end in ``mixed``: every column of ``docs``, copy, shuffle_key."""
    shares = ", ".join(f"('{name}', CAST({share} AS DOUBLE))" for name, share in targets.items())
    names = ", ".join(f"'{name}'" for name in targets)
    unit = "CAST(CAST(concat('0x', substr(md5(concat_ws(':', {parts})), 1, 13)) AS BIGINT) AS DOUBLE) / pow(16, 13)"
    drawn = unit.format(parts=f"'{seed}', coalesce(CAST(doc_id AS VARCHAR), 'null')")
    return f"""
shares(mixed, share) AS (VALUES {shares}),
keyed AS (SELECT *, CASE WHEN source IN ({names}) THEN source END AS mixed FROM {docs}),
sizes AS (SELECT mixed, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS size FROM keyed GROUP BY mixed),
means AS (
  SELECT s.mixed, CASE WHEN size > 0
    THEN coalesce(share, 1 - (SELECT sum(share) FROM shares)) * (SELECT sum(size) FROM sizes) / size ELSE 1 END AS mean
  FROM sizes s LEFT JOIN shares t ON s.mixed = t.mixed),
ks AS (SELECT mixed, mean, unnest(range(0, CAST(ceil(mean + 12 * sqrt(mean) + 30) AS BIGINT) + 1)) AS k FROM means WHERE mean > 0),
facts AS (SELECT k, sum(CASE WHEN k = 0 THEN 0 ELSE ln(k) END) OVER (ORDER BY k) AS logs FROM (SELECT DISTINCT k FROM ks)),
steps AS (
  SELECT mixed, list(cdf ORDER BY k) AS cdf FROM (
    SELECT mixed, k, sum(exp(k * ln(mean) - mean - logs)) OVER (PARTITION BY mixed ORDER BY k) AS cdf
    FROM ks JOIN facts USING (k)) GROUP BY mixed),
counted AS (
  SELECT d.* EXCLUDE (mixed), len(list_filter(cdf, lambda p: p <= {drawn})) AS n
  FROM keyed d JOIN steps s ON d.mixed IS NOT DISTINCT FROM s.mixed),
copies AS (SELECT * EXCLUDE (n), CAST(unnest(range(1, n + 1)) AS INTEGER) AS copy FROM counted WHERE n > 0),
mixed AS (
  SELECT *, md5(concat_ws(':', '{seed}', coalesce(CAST(doc_id AS VARCHAR), 'null'), CAST(copy AS VARCHAR), 'order')) AS shuffle_key
  FROM copies)"""


ORACLES["op5_mixed_sources"] = f"""WITH {mixed_sources('documents', TARGETS, SEED)}
SELECT doc_id, copy, shuffle_key, source, text FROM mixed"""

ORACLES["op1_warc_archives"] = """WITH
pages_of AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
made AS (SELECT page_id, CAST(octet_length(payload) AS BIGINT) AS payload_bytes, sha1(payload) AS payload_digest FROM pages_of),
firsts AS (SELECT payload_digest, max(page_id) AS first FROM made WHERE payload_bytes >= 1000 GROUP BY 1),
marked AS (
  SELECT m.*, CASE WHEN payload_bytes >= 1000 AND page_id <> first THEN first END AS refers_to
  FROM made m LEFT JOIN firsts USING (payload_digest))
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN refers_to IS NULL THEN 'response' ELSE 'revisit' END AS record_type, refers_to
FROM marked"""

# CRC-32 (polynomial 0xEDB88320) of the digits of an id, bit by bit.
_CRC = """xor(list_reduce(
    list_concat([4294967295::BIGINT], list_transform(range(0, 8 * length({s})),
      lambda k: CASE WHEN k % 8 = 0 THEN ascii({s}[k // 8 + 1])::BIGINT ELSE 0 END)),
    lambda c, b: xor(xor(c, b) >> 1, 3988292384::BIGINT * (xor(c, b) & 1))), 4294967295::BIGINT)"""

ORACLES["op12_prefix_trie"] = f"""WITH
numbered AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS n
  FROM conversations WHERE conv_id IS NOT NULL),
sizes AS (SELECT conv_id, count(*) AS own, {_CRC.format(s="CAST(conv_id AS VARCHAR)")} % 9 AS h FROM numbered GROUP BY conv_id),
convs AS (
  SELECT s.conv_id, s.h, b.conv_id AS base, least(s.h, coalesce(b.own, 0)) AS lent,
    least(s.h, coalesce(b.own, 0)) + greatest(s.own - s.h, 0) AS turns
  FROM sizes s LEFT JOIN sizes b ON b.conv_id = s.conv_id - s.conv_id % 5),
rebuilt AS (
  SELECT c.conv_id, lent + n - h AS position, turns, role, text FROM convs c JOIN numbered USING (conv_id) WHERE n > h
  UNION ALL
  SELECT c.conv_id, n AS position, turns, role, text FROM convs c JOIN numbered b ON b.conv_id = c.base WHERE n <= h),
pathed AS (
  SELECT conv_id, position AS depth, turns, text,
    md5(string_agg(concat(length(role), ':', role, length(text), ':', text), '') OVER (PARTITION BY conv_id ORDER BY position)) AS node
  FROM rebuilt
  UNION ALL SELECT conv_id, 0, turns, '', 'root' FROM convs),
nodes AS (
  SELECT depth, node, min(conv_id) AS owner, count(*) AS n_convs, (count(*) - 1) * octet_length(encode(min(text))) AS saved,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (WHERE turns = depth), '')) AS ends_sha256
  FROM pathed GROUP BY depth, node),
linked AS (
  SELECT n.*, p.node AS above FROM nodes n LEFT JOIN pathed p ON p.conv_id = n.owner AND p.depth = n.depth - 1),
children AS (SELECT depth - 1 AS depth, above AS node, count(*) AS n_children FROM linked WHERE depth > 0 GROUP BY ALL),
counted AS (SELECT l.*, coalesce(n_children, 0) AS n_children FROM linked l LEFT JOIN children USING (depth, node)),
totals AS (
  SELECT a.depth, a.node, count_if(d.n_children = 0) AS n_leaves, sum(d.saved) AS saved_tokens
  FROM counted d JOIN pathed a ON a.conv_id = d.owner AND a.depth <= d.depth GROUP BY a.depth, a.node)
SELECT c.owner AS conv_id, c.depth, p.owner AS parent_conv_id, c.n_convs, c.n_children,
  CAST(n_leaves AS BIGINT) AS n_leaves, CAST(saved_tokens AS BIGINT) AS saved_tokens, c.ends_sha256
FROM counted c JOIN totals USING (depth, node) LEFT JOIN nodes p ON p.depth = c.depth - 1 AND p.node = c.above"""

ORACLES["op13_hard_negatives"] = """WITH
taking_part AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS numbers
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
    CAST(list_dot_product(a.numbers, r.numbers) AS BIGINT) AS score
  FROM taking_part a JOIN taking_part r ON a.vec_id <> r.vec_id WHERE a.vec_id % 100 = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
ranked AS (
  SELECT p.*, s.vec_id AS negative_id, s.score AS negative_score,
    row_number() OVER (PARTITION BY anchor_id, positive_id ORDER BY s.score DESC, s.vec_id) AS rank
  FROM positives p JOIN scored s USING (anchor_id)
  WHERE NOT s.same AND 30 * positive_score <= 100 * s.score AND 100 * s.score <= 90 * positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score
FROM ranked WHERE rank <= 10"""
