"""SQL of the operators that SQL can express, over the same tables."""

from __future__ import annotations

_URL_RULES = r"""
WITH parsed AS (
  SELECT page_id,
         translate(regexp_extract(coalesce(url, ''), '(?s)^.*?://([^/?#]*)', 1),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(coalesce(url, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1) AS path
  FROM pages
),
rules(rule_host, rule_path, rule_verdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
),
judged AS (
  SELECT page_id, host, path,
         (SELECT max_by({'rule': rule_host || rule_path, 'verdict': rule_verdict}, length(rule_host || rule_path))
          FROM rules
          WHERE (host = rule_host OR ends_with(host, '.' || rule_host)) AND starts_with(path, rule_path)) AS best
  FROM parsed
)
SELECT page_id, host, path, best.rule AS rule, coalesce(best.verdict, 'allow') AS verdict FROM judged
"""

_CHAT = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -7, i, CASE i WHEN 0 THEN 'user' ELSE 'assistant' END, '</s>[INST] ok [/INST]' FROM range(2) AS t(i)
),
shown AS (
  SELECT *, regexp_replace(text, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\2\\\3', 'g') AS safe,
         regexp_replace(role, '([<\[])(\\*)(s>|/s>|INST\]|/INST\])', '\1\2\\\3', 'g') AS safe_role
  FROM turns
)
SELECT conv_id,
       count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length('<s>' || safe_role || '[INST]' || safe || '[/INST]</s>'))::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""


_WARC = r"""
WITH payloads AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS digest FROM pages
),
firsts AS (
  SELECT *, min(page_id) OVER (PARTITION BY digest, payload_bytes) AS first_page FROM payloads
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(32), lambda i:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', 1 + CAST(
           ((strpos('0123456789abcdef', substr(digest || '0', 1 + 5 * i // 4, 1)) - 1) * 16
             + strpos('0123456789abcdef', substr(digest || '0', 2 + 5 * i // 4, 1)) - 1)
           // CAST(pow(2, 3 - 5 * i % 4) AS BIGINT) % 32 AS BIGINT), 1)), '') AS payload_digest,
       CASE WHEN page_id = first_page THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> first_page THEN first_page END AS refers_to
FROM firsts
"""

_FILTER_AUDIT = r"""
WITH words AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS words
  FROM documents
),
failed AS (
  SELECT w.doc_id, part,
         [len(words) < 200,
          100 * len(list_distinct(words)) < 50 * len(words),
          100 * length(regexp_replace(text, '[^A-Z]', '', 'g')) > 3 * length(text),
          regexp_matches(text, '[#$%&*|]'),
          coalesce(w.doc_id > min(w.doc_id) OVER (PARTITION BY text), false)] AS fails,
         coalesce(quality = 1, false) AS good, coalesce(toxic = 1, false) AS bad
  FROM words w LEFT JOIN labels l ON w.doc_id = l.doc_id
),
masks AS (
  SELECT part, fails, count(*) AS n, count(*) FILTER (good) AS good, count(*) FILTER (bad) AS toxic FROM failed GROUP BY part, fails
),
letters(letter, bit) AS (VALUES ('A', 1), ('B', 2), ('C', 3), ('D', 4), ('E', 5)),
orders AS (
  SELECT a.letter || b.letter || c.letter || d.letter || e.letter AS filter_order, [a.bit, b.bit, c.bit, d.bit, e.bit] AS bits
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.bit, b.bit, c.bit, d.bit, e.bit])) = 5
),
steps AS (
  SELECT part, filter_order, step, bits[step] AS bit, n, good, toxic, fails[bits[step]] AS fails_here,
         len(list_filter(bits[1:step - 1], lambda b: fails[b])) > 0 AS gone,
         len(list_filter(fails, lambda f: f)) = 1 AS once
  FROM masks, orders, (SELECT unnest(range(1, 6)) AS step)
),
summed AS (
  SELECT part, filter_order, CAST(step AS INTEGER) AS step, bit,
         coalesce(sum(n) FILTER (NOT fails_here AND NOT gone), 0)::BIGINT AS kept,
         coalesce(sum(n) FILTER (fails_here AND NOT gone), 0)::BIGINT AS removed,
         coalesce(sum(n) FILTER (fails_here AND gone), 0)::BIGINT AS redundant,
         coalesce(sum(n) FILTER (fails_here AND once), 0)::BIGINT AS unique_fails,
         coalesce(sum(good) FILTER (fails_here AND NOT gone), 0)::BIGINT AS good_lost,
         coalesce(sum(toxic) FILTER (fails_here AND NOT gone), 0)::BIGINT AS toxic_lost
  FROM steps GROUP BY ALL
)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost,
       (sum(removed) OVER (PARTITION BY part, bit))::BIGINT AS shapley
FROM summed
"""


def oracle_sql() -> dict[str, str]:
    return {"op3_chat": _CHAT, "op8_url_rules": _URL_RULES, "op12_warc": _WARC, "op13_filter_audit": _FILTER_AUDIT}
