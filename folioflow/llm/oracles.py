"""SQL twins of the queries that SQL can express."""

from __future__ import annotations

ORACLES: dict[str, str] = {
    "op9_warc": """
        WITH page AS (SELECT page_id, coalesce(html, '') AS payload FROM pages),
        sized AS (SELECT *, CAST(octet_length(encode(payload)) AS BIGINT) AS payload_bytes FROM page),
        grouped AS (SELECT *, max(page_id) OVER (PARTITION BY payload) AS response FROM sized)
        SELECT page_id, payload_bytes, sha1(payload) AS payload_digest,
            CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN 'revisit' ELSE 'response' END AS record_type,
            CASE WHEN payload_bytes >= 1000 AND page_id <> response THEN response END AS refers_to
        FROM grouped
    """,
}
