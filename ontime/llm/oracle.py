"""The SQL that gives the rows of a query, for the operators SQL can express."""

from __future__ import annotations

MARK = r"(<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|</?s>|\[/?INST\]|<</?SYS>>)"

CHAT = rf"""
WITH given AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -7, 1, 'assistant', '</s>[INST] ok [/INST]'),
sized AS (
  SELECT *, row_number() OVER w AS place, count(*) OVER (PARTITION BY conv_id) AS turns,
         length('<|im_start|>') + 1 + length('<|im_end|>') + 1
         + length(role) + len(regexp_extract_all(role, '[\\\n]')) + len(regexp_extract_all(role, '{MARK}'))
         + length(text) + len(regexp_extract_all(text, '\\')) + len(regexp_extract_all(text, '{MARK}')) AS chars
  FROM given WINDOW w AS (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text)),
summed AS (
  SELECT *, sum(chars) OVER (PARTITION BY conv_id ORDER BY place) AS prefix FROM sized)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY place)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY place) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(prefix) FILTER (role = 'assistant' OR place = turns) AS BIGINT) AS formatted_chars
FROM summed GROUP BY conv_id
"""

WARC = """
WITH sized AS (
  SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS payload_digest
  FROM pages),
kept AS (
  SELECT payload_digest, max(page_id) AS keeper FROM sized WHERE payload_bytes >= 1000 GROUP BY payload_digest)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
       CASE WHEN keeper IS NOT NULL AND keeper <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN keeper <> page_id THEN keeper END AS refers_to
FROM sized LEFT JOIN kept USING (payload_digest)
"""


def oracle_sql() -> dict[str, str]:
    return {"op1_chat_formatting": CHAT, "op10_warc": WARC}
