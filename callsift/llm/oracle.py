"""SQL for DuckDB that gives the same rows as a registered query, where SQL can."""

from __future__ import annotations

SQL = {
    "op2_warc": """
        WITH raw AS (
          SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages
        ), sized AS (
          SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS payload_digest FROM raw
        ), kept AS (
          SELECT *, CASE WHEN payload_bytes >= 1000
            THEN max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) ELSE page_id END AS keeper
          FROM sized
        )
        SELECT page_id, payload_bytes, payload_digest,
          CASE WHEN keeper = page_id THEN 'response' ELSE 'revisit' END AS record_type,
          CASE WHEN keeper <> page_id THEN keeper END AS refers_to
        FROM kept
    """,
    "op11_hard_negatives": """
        WITH fine AS (
          SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
            list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
          FROM embeddings
          WHERE label IS NOT NULL AND embedding IS NOT NULL
            AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = len(embedding)
        ), scored AS (
          SELECT a.vec_id AS anchor_id, b.vec_id AS vec_id, a.label = b.label AS alike,
            CAST(list_sum(list_transform(range(1, len(a.v) + 1), lambda i: a.v[i] * b.v[i])) AS BIGINT) AS score
          FROM fine a JOIN fine b ON a.vec_id <> b.vec_id
          WHERE a.vec_id % 100 = 0
        ), positives AS (
          SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE alike
          QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5
        )
        SELECT p.anchor_id, p.positive_id,
          CAST(row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY n.score DESC, n.vec_id) AS INTEGER) AS rank,
          n.vec_id AS negative_id, p.positive_score, n.score AS negative_score
        FROM positives p JOIN scored n ON n.anchor_id = p.anchor_id AND NOT n.alike
          AND 80 * p.positive_score <= 100 * n.score AND n.score <= p.positive_score
        QUALIFY rank <= 5
    """,
}
