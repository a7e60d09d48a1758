"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

from tidemark.llm.mixing import oracle as mixing_sql
from tidemark.llm.quality_rules import oracle as quality_sql

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

ORACLES = {
    "op5_mixing": mixing_sql(),
    "op4_warc": """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS payload, sha1(coalesce(html, '')) AS d FROM pages
), g AS (SELECT payload AS gp, max(page_id) AS best FROM p GROUP BY payload)
SELECT page_id, CAST(strlen(payload) AS BIGINT) AS payload_bytes,
  array_to_string(list_transform(range(0, 8), lambda k: array_to_string(list_transform([32768, 1024, 32, 1],
    lambda w: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', (CAST(('0x' || substr(d, 5 * k + 1, 5)) AS BIGINT) // w) % 32 + 1, 1)), '')), '') AS payload_digest,
  CASE WHEN best IS NULL OR page_id = best THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> best THEN best END AS refers_to
FROM p JOIN g ON payload = gp
""",
    "op6_quality_rules": quality_sql(),
    "op9_ngram_join": rf"""
WITH RECURSIVE d AS MATERIALIZED (
  SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, array_to_string(w[i:i + 2], ' ') AS g FROM d, unnest(range(1, greatest(len(w) - 2, 1) + 1)) AS u(i) WHERE len(w) > 0
), n AS MATERIALIZED (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
o AS MATERIALIZED (
  SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS o FROM s AS a JOIN s AS b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), e AS MATERIALIZED (
  SELECT a, b FROM o JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * o >= 90 * (x.n + y.n - o)
), both_ways AS MATERIALIZED (SELECT a, b FROM e UNION ALL SELECT b, a FROM e),
r AS (SELECT a AS doc_id, b AS other FROM both_ways UNION SELECT r.doc_id, t.b FROM r JOIN both_ways AS t ON t.a = r.other)
SELECT d.doc_id, coalesce(n.n, 0) AS n_shingles, least(d.doc_id, coalesce(c.low, d.doc_id)) AS component_id, coalesce(k.n_links, 0) AS n_links
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN (SELECT a AS doc_id, count(*) AS n_links FROM both_ways GROUP BY a) AS k USING (doc_id) LEFT JOIN (SELECT doc_id, min(other) AS low FROM r GROUP BY doc_id) AS c USING (doc_id)
""",
    "op10_decontamination": rf"""
WITH d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM documents
), b AS (
  SELECT item_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[\x00-\x2F\x3A-\x60\x7B-\x7F]+'), lambda x: x <> '') AS w
  FROM benchmark
), win AS MATERIALIZED (
  SELECT DISTINCT item_id, w[s] AS head, w[s + least(13, len(w)) - 1] AS tail, least(13, len(w)) AS m, w[s:s + least(13, len(w)) - 1] AS k
  FROM b, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS u(s) WHERE len(w) > 0
), places AS MATERIALIZED (SELECT rid, unnest(w) AS word, generate_subscripts(w, 1) AS s FROM d),
begun AS MATERIALIZED (
  SELECT x.rid, x.s, m, k, item_id FROM places AS x JOIN win ON x.word = head JOIN places AS y ON y.rid = x.rid AND y.s = x.s + m - 1 AND y.word = tail
),
hit AS MATERIALIZED (SELECT rid, s, m, item_id FROM begun JOIN d USING (rid) WHERE w[s:s + m - 1] = k),
pos AS (SELECT rid, count(DISTINCT s + o) AS n_hit FROM hit, unnest(range(0, m)) AS u(o) GROUP BY rid),
it AS (SELECT rid, count(*) AS n_items, string_agg(i, ',' ORDER BY i) AS ids FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS i FROM hit) GROUP BY rid)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (rid) LEFT JOIN it USING (rid)
""",
    "op12_chat_formatting": r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, u.turn, u.role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS u(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length(regexp_replace(role, '<(\\*)\|', '<\1\\|', 'g')) + length(regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g')) + length('<|im_start|><|im_sep|><|im_end|>') + 1) AS BIGINT) AS formatted_chars
FROM t GROUP BY conv_id
""",
    "op13_fill_in_middle": """
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, sha256('7:' || doc_id) AS h FROM documents
), u AS (
  SELECT *, string_split(t, chr(10)) AS parts,
    length(t) - length(replace(t, chr(10), '')) + CASE WHEN t <> '' AND right(t, 1) <> chr(10) THEN 1 ELSE 0 END AS n,
    CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2, CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4
  FROM d
), k AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS i, greatest(h1 % (n + 1), h2 % (n + 1)) AS j,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 100 THEN 'plain' WHEN h4 % 100 < 50 THEN 'spm' ELSE 'psm' END AS form
  FROM u
), c AS (
  SELECT *, CASE WHEN i = n THEN length(t) WHEN i = 0 THEN 0 ELSE length(array_to_string(parts[1:i], chr(10))) + 1 END AS a,
    CASE WHEN j = n THEN length(t) WHEN j = 0 THEN 0 ELSE length(array_to_string(parts[1:j], chr(10))) + 1 END AS b
  FROM k
), o AS (
  SELECT *, substr(t, 1, a) AS p, substr(t, a + 1, b - a) AS m, substr(t, b + 1) AS s FROM c
)
SELECT doc_id, CAST(n AS BIGINT) AS n, form, CASE WHEN form <> 'plain' THEN CAST(a AS BIGINT) END AS prefix_chars, CASE WHEN form <> 'plain' THEN CAST(b - a AS BIGINT) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM o
""",
}
