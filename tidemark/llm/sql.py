"""The queries that DuckDB can answer from the same tables."""

from __future__ import annotations

from tidemark.llm.warc import ALPHABET

_LETTERS = " || ".join(
    f"substr('{ALPHABET}', ((('0x' || substr(h, {5 * i + 1}, 5))::BIGINT >> {shift}) & 31)::INT + 1, 1)"
    for i in range(8) for shift in (15, 10, 5, 0))

ORACLE = {
    "op4_warc": f"""
        WITH hexed AS (
            SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS h FROM pages
        ), digested AS (SELECT page_id, payload_bytes, {_LETTERS} AS payload_digest FROM hexed),
        firsts AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_page FROM digested)
        SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
               CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> first_page THEN first_page END AS refers_to
        FROM firsts""",
}
