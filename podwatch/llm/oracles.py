"""SQL for the queries that SQL can express over whole tables."""

from __future__ import annotations

OP3 = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), keyed AS (
  SELECT doc_id, pos, line,
         translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM lines
), shared AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40
  GROUP BY key HAVING count(DISTINCT doc_id) >= 5
), marked AS (
  SELECT k.*, s.key IS NOT NULL AND s.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN shared s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""

OP1 = """
WITH hashed AS (
  SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes, sha1(coalesce(html, '')) AS hex FROM pages
), named AS (
  SELECT *, max(page_id) OVER (PARTITION BY hex) AS last FROM hashed
)
SELECT page_id, payload_bytes,
       array_to_string(list_transform(range(0, 32), lambda k:
         substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                1 + ((CAST('0x' || substr(hex, 1 + 5 * (k // 4), 5) AS BIGINT) >> (15 - 5 * (k % 4))) & 31)::INT, 1)), '') AS payload_digest,
       CASE WHEN page_id = last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id <> last THEN last END AS refers_to
FROM named
"""

# Near-duplicates by brute force: all pairs that share a shingle, then the smallest reachable document.
OP2 = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, list_filter(regexp_split_to_array(
           translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
           '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM documents
), sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_distinct(list_transform(range(1, len(w) - 3), lambda k: array_to_string(w[k:k + 4], ' '))) END AS s
  FROM words
), items AS (
  SELECT doc_id, len(s) AS n, unnest(s) AS x FROM sets
), pairs AS (
  SELECT a.doc_id AS a, b.doc_id AS b, any_value(a.n) AS na, any_value(b.n) AS nb, count(*) AS shared
  FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM pairs WHERE 100 * shared >= 75 * (na + nb - shared)
), edges AS (
  SELECT a, b FROM links UNION ALL SELECT b, a FROM links
), reach(doc_id, other) AS (
  SELECT doc_id, doc_id FROM documents
  UNION
  SELECT r.doc_id, e.b FROM reach r JOIN edges e ON r.other = e.a
), least AS (
  SELECT doc_id, min(other) AS component_id FROM reach GROUP BY doc_id
)
SELECT doc_id, len(s) AS n_shingles, component_id, doc_id = component_id AS kept FROM sets JOIN least USING (doc_id)
"""

OP7 = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), sized AS (
  -- An escaped control string or escape character has two characters.
  SELECT *, length(replace(text, '~', '~0')) AS plain,
         length(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(replace(text, '~', '~0'),
           '<|im_start|>', '~a'), '<|im_sep|>', '~b'), '<|im_end|>', '~c'), '<|endoftext|>', '~d'), '[INST]', '~e'),
           '[/INST]', '~f'), '<s>', '~g'), '</s>', '~h'), '<<SYS>>', '~i'), '<</SYS>>', '~j')) AS size,
         lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (WHERE role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (WHERE role = 'assistant'), '')) AS loss_sha256,
       sum(CASE WHEN before = role THEN length('<|im_sep|>') + size
                ELSE length('<|im_start|>') + length(role) + 1 + size + length('<|im_end|>') + 1 END)::BIGINT AS formatted_chars
FROM sized GROUP BY conv_id
"""

OP8 = r"""
WITH captures AS (
  SELECT DISTINCT page_id, url, 1704067200 + (page_id * 7919 % 527040) * 60 AS fetched_at,
         rtrim(lower(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)', 1)), '.') AS host,
         regexp_extract(url, '^[a-z]+://[^/?#]*/([^/?#]+)', 1) AS first,
         list_filter(string_split(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*(/[^?#]*)', 1), '/'), lambda p: p <> '') AS parts
  FROM pages
), patterns AS (
  SELECT DISTINCT 'hosts' AS list, host AS pattern FROM captures WHERE host <> ''
  UNION ALL SELECT DISTINCT 'domains', '*.' || array_to_string(string_split(host, '.')[-3:], '.') FROM captures WHERE host <> ''
  UNION ALL SELECT DISTINCT 'paths', host || '/' || first FROM captures WHERE host <> '' AND first <> ''
), numbered AS (
  SELECT *, CAST('0x' || substr(md5(pattern), 1, 6) AS BIGINT) AS v FROM patterns
), entries AS (
  SELECT list, pattern, action, 1704067200 + (v % 200 + day) * 86400 AS since
  FROM numbered JOIN (VALUES ('hosts', 0, 'block'), ('hosts', 60, 'end'), ('hosts', 120, 'block'), ('domains', -100, 'block'),
    ('domains', 70, 'allow'), ('domains', 140, 'end'), ('paths', 10, 'allow'), ('paths', 90, 'block')) e(list, day, action) USING (list)
  WHERE CASE list WHEN 'hosts' THEN v % 3 = 0 WHEN 'domains' THEN v % 2 = 1 ELSE v % 5 = 2 END
), active AS (
  SELECT c.page_id, c.url, c.fetched_at, c.host, e.list, e.pattern, arg_max(e.action, e.since) AS action, max(e.since) AS since
  FROM captures c JOIN entries e ON e.since <= c.fetched_at AND (
       e.pattern = c.host
    OR (e.pattern LIKE '*.%' AND ends_with('.' || c.host, substr(e.pattern, 2)))
    OR (e.list = 'paths' AND starts_with(c.host || '/' || array_to_string(c.parts, '/') || '/', e.pattern || '/')))
  GROUP BY ALL
), best AS (
  SELECT *, row_number() OVER (PARTITION BY page_id, url, fetched_at
    ORDER BY length(regexp_replace(pattern, '^\*\.', '')) DESC, pattern NOT LIKE '*.%' DESC, action = 'allow' DESC, since DESC, list DESC, pattern DESC) AS r
  FROM active WHERE action <> 'end'
)
SELECT c.page_id, c.host, coalesce(b.action, 'none') AS verdict, b.list, b.pattern, c.fetched_at, b.since
FROM captures c LEFT JOIN best b ON c.page_id = b.page_id AND c.url = b.url AND c.fetched_at = b.fetched_at AND b.r = 1
"""

ORACLES: dict[str, str] = {
    "op1_warc": OP1,
    "op2_near_dedup": OP2,
    "op3_line_dedup": OP3,
    "op7_chat": OP7,
    "op8_url_filters": OP8,
}
