"""DuckDB SQL of the queries that SQL can express, on the given tables."""

from __future__ import annotations

# Dynamic programming over rows and states ('' nothing said, else the last initial), where every state keeps the
# cheapest edits, ties ASCII-least. Before each row, and at the end, up to two rows are inserted.
OP11 = r"""
WITH RECURSIVE
said AS (
  SELECT conv_id, coalesce(conv_id::VARCHAR, ' ') AS k, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
    xor(list_reduce(
      list_prepend(4294967295::BIGINT, list_transform(
        string_split(coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' '), ''), lambda c: ascii(c)::BIGINT)),
      lambda h, b: list_reduce(list_prepend(xor(h, b), range(8)),
        lambda x, y: CASE WHEN x & 1 = 1 THEN xor(x >> 1, 3988292384::BIGINT) ELSE x >> 1 END)
    ), 4294967295::BIGINT) % 20 AS kind
  FROM conversations
),
damaged AS (
  SELECT k, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
    unnest(range(CASE kind WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM said WHERE kind <> 0
),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY k ORDER BY turn NULLS FIRST, role, md5(text), copy) AS i,
    regexp_replace(text, '[\x20\x09-\x0D]+$', '') AS bare
  FROM damaged
),
judged AS (
  SELECT *, left(role, 1) AS initial, CASE
      WHEN bare = '' THEN 'blank'
      WHEN row_number() OVER (PARTITION BY k, role, text ORDER BY i) > 1 THEN 'duplicate'
      WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault,
    lead(left(role, 1)) OVER (PARTITION BY k ORDER BY i) AS next_initial
  FROM placed
),
faults AS (
  SELECT k, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
    count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
    count(*) FILTER (fault = 'truncated') AS truncated,
    count(*) FILTER (next_initial IS NOT NULL AND initial || next_initial NOT IN ('su', 'ua', 'au')) AS illegal, count(*) AS n
  FROM judged GROUP BY k
),
inserts(q, after, inserted, lines) AS (VALUES
  ('', '', '', ''), ('', 'u', 'I', 'user:' || chr(10)), ('', 'a', 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  ('s', 's', '', ''), ('s', 'u', 'I', 'user:' || chr(10)), ('s', 'a', 'II', 'user:' || chr(10) || 'assistant:' || chr(10)),
  ('u', 'u', '', ''), ('u', 'a', 'I', 'assistant:' || chr(10)), ('a', 'a', '', ''), ('a', 'u', 'I', 'user:' || chr(10))
),
moves(q, edit, initial, goal, cost) AS (VALUES
  ('', 'D', NULL, '', 4), ('s', 'D', NULL, 's', 4), ('u', 'D', NULL, 'u', 4), ('a', 'D', NULL, 'a', 4),
  ('', 'K', 's', 's', 0), ('', 'K', 'u', 'u', 0), ('s', 'K', 'u', 'u', 0), ('u', 'K', 'a', 'a', 0), ('a', 'K', 'u', 'u', 0),
  ('', 'R', NULL, 'u', 3), ('s', 'R', NULL, 'u', 3), ('u', 'R', NULL, 'a', 3), ('a', 'R', NULL, 'u', 3)
),
walk(k, i, q, cost, audit, lines) AS (
  SELECT k, 0::BIGINT, '', 0::BIGINT, '', '' FROM faults
  UNION ALL
  SELECT k, i, goal, cost, audit, lines FROM (
    SELECT *, row_number() OVER (PARTITION BY k, goal ORDER BY cost, audit) AS best FROM (
      SELECT w.k, r.i, m.goal,
        w.cost + 3 * length(n.inserted) + m.cost + CASE WHEN r.fault = 'truncated' AND m.edit <> 'D' THEN 3 ELSE 0 END AS cost,
        w.audit || n.inserted || m.edit AS audit,
        w.lines || n.lines || CASE m.edit WHEN 'D' THEN '' WHEN 'K' THEN r.role || ':' || r.text || chr(10)
          ELSE CASE m.goal WHEN 'u' THEN 'user' ELSE 'assistant' END || ':' || r.text || chr(10) END AS lines
      FROM walk w JOIN judged r ON r.k = w.k AND r.i = w.i + 1
        JOIN inserts n ON n.q = w.q
        JOIN moves m ON m.q = n.after AND (m.initial IS NULL OR m.initial = r.initial)
      WHERE m.edit = 'D' OR r.fault NOT IN ('blank', 'duplicate')
    )
  ) WHERE best = 1
),
ends AS (
  SELECT w.k, w.cost + 3 * length(n.inserted) AS cost, w.audit || n.inserted AS audit, w.lines || n.lines AS lines,
    row_number() OVER (PARTITION BY w.k ORDER BY w.cost + 3 * length(n.inserted), w.audit || n.inserted) AS best
  FROM walk w JOIN faults f ON f.k = w.k AND f.n = w.i JOIN inserts n ON n.q = w.q AND n.after IN ('', 'a')
),
everyone AS (SELECT DISTINCT conv_id, k FROM said)
SELECT conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, coalesce(cost, 0)::BIGINT AS cost,
  coalesce(audit, '') AS audit, sha256(coalesce(left(lines, length(lines) - 1), '')) AS repaired_sha256
FROM everyone LEFT JOIN faults USING (k) LEFT JOIN (SELECT * FROM ends WHERE best = 1) USING (k)
"""

# All pairs of a label, and who is reached over links.
OP2 = """
WITH RECURSIVE
rows_of AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e, row_number() OVER () AS r FROM embeddings
),
usable AS (
  SELECT * FROM rows_of
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND len(e) > 0 AND list_aggregate(list_transform(e, lambda x:
    CASE WHEN x IS NULL OR NOT isfinite(x) THEN 1 ELSE 0 END), 'sum') = 0
    AND list_aggregate(list_transform(e, lambda x: abs(x)), 'max') > 0
),
links AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM usable a JOIN usable b ON a.label = b.label AND a.r <> b.r AND len(a.e) = len(b.e)
  WHERE list_cosine_similarity(a.e, b.e) >= 0.98
),
reached(x, low) AS (
  SELECT vec_id, vec_id FROM usable
  UNION
  SELECT links.y, reached.low FROM reached JOIN links ON links.x = reached.x WHERE reached.low < links.y
),
lowest AS (SELECT x, min(low) AS low FROM reached GROUP BY x),
counted AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, coalesce(low, vec_id) AS component_id, vec_id IS NOT DISTINCT FROM coalesce(low, vec_id) AS kept
FROM rows_of LEFT JOIN counted ON counted.x = vec_id LEFT JOIN lowest ON lowest.x = vec_id
"""
