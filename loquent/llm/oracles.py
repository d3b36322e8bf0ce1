"""SQL for DuckDB of the queries that SQL can express."""

from __future__ import annotations

from loquent.llm.common import LOWER, UPPER

#: Base32 letters: five hex digits make four of them.
_BASE32 = "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567"

ORACLES = {
    "op1_warc": f"""
        WITH body AS (SELECT page_id, coalesce(html, '') AS html FROM pages),
        hashed AS (SELECT page_id, strlen(html) AS payload_bytes, sha1(html) AS h FROM body),
        first AS (SELECT *, min(page_id) OVER (PARTITION BY h, payload_bytes) AS f FROM hashed)
        SELECT page_id, payload_bytes,
               array_to_string(list_transform(range(32), lambda i: substr('{_BASE32}', 1 + CAST(
                   (CAST('0x' || substr(h, 5 * (i // 4) + 1, 5) AS BIGINT)
                    >> CAST(5 * (3 - i % 4) AS BIGINT)) & 31 AS INT), 1)), '') AS payload_digest,
               CASE WHEN page_id = f THEN 'response' ELSE 'revisit' END AS record_type,
               CASE WHEN page_id <> f THEN f END AS refers_to
        FROM first
    """,
    "op6_exact_dedup": f"""
        WITH keyed AS (
            SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS digest
            FROM documents),
        kept AS (SELECT digest, max(doc_id) AS keep_id, count(*) AS group_size
                 FROM keyed GROUP BY digest)
        SELECT doc_id, keep_id, group_size,
               doc_id IS NOT DISTINCT FROM keep_id AS kept, digest AS text_sha256
        FROM keyed JOIN kept USING (digest)
    """,
}
