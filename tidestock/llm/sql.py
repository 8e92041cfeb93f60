"""SQL texts of the text queries that SQL can express, independent of the operators' methods."""

from __future__ import annotations

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_WORDS = rf"regexp_extract_all(translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

REPLY_TREES = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL
  SELECT -1, turn, role, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) AS t(turn, role)
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  CAST(sum(length('<|im_start|>' || '<|im_end|>') + 2 + length(role) + length(text)
      + len(regexp_extract_all(text, '<\\*\|'))) AS BIGINT) AS formatted_chars
FROM turns GROUP BY conv_id
"""

REPEATED_STRINGS = """
WITH docs AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents),
windows AS (
  SELECT doc_id, p, hash(substr(h, CAST(2 * p + 1 AS INTEGER), 100)) AS w
  FROM (SELECT doc_id, h, unnest(range(len(h) // 2 - 49)) AS p FROM docs WHERE len(h) >= 100)),
repeats AS (SELECT doc_id, p FROM (SELECT *, min(doc_id) OVER (PARTITION BY w) AS least FROM windows) WHERE least < doc_id),
starts AS (SELECT *, coalesce(p > lag(p) OVER (PARTITION BY doc_id ORDER BY p) + 50, true) AS is_new FROM repeats),
numbered AS (SELECT *, count(*) FILTER (is_new) OVER (PARTITION BY doc_id ORDER BY p) AS span FROM starts),
spans AS (SELECT doc_id, span, min(p) AS a, max(p) + 50 AS b FROM numbered GROUP BY doc_id, span),
gaps AS (
  SELECT doc_id, coalesce(lag(b) OVER (PARTITION BY doc_id ORDER BY a), 0) AS a, a AS b FROM spans
  UNION ALL
  SELECT d.doc_id, coalesce(max(s.b), 0), any_value(len(d.h) // 2) FROM docs d LEFT JOIN spans s ON s.doc_id = d.doc_id GROUP BY d.doc_id),
kept AS (
  SELECT g.doc_id, sha256(unhex(string_agg(substr(d.h, CAST(2 * g.a + 1 AS INTEGER), CAST(2 * (g.b - g.a) AS INTEGER)), '' ORDER BY g.a, g.b))) AS kept_sha256
  FROM gaps g JOIN docs d ON d.doc_id = g.doc_id GROUP BY g.doc_id)
SELECT d.doc_id, CAST(len(d.h) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(s.removed, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(s.n, 0) AS BIGINT) AS n_spans, k.kept_sha256
FROM docs d JOIN kept k ON k.doc_id = d.doc_id
LEFT JOIN (SELECT doc_id, sum(b - a) AS removed, count(*) AS n FROM spans GROUP BY doc_id) s ON s.doc_id = d.doc_id
"""

BENCHMARK_SPANS = f"""
WITH docs AS (SELECT doc_id, {_WORDS} AS ws FROM documents),
items AS (SELECT item_id, ws, least(10, len(ws)) AS size FROM (SELECT item_id, {_WORDS} AS ws FROM benchmark) WHERE len(ws) > 0),
item_windows AS (
  SELECT DISTINCT item_id, size, array_to_string(ws[k : k + size - 1], ' ') AS w
  FROM (SELECT *, unnest(range(1, len(ws) - size + 2)) AS k FROM items)),
doc_windows AS (
  SELECT doc_id, size, p, array_to_string(ws[p : p + size - 1], ' ') AS w
  FROM (SELECT doc_id, ws, size, unnest(range(1, len(ws) - size + 2)) AS p
        FROM docs, (SELECT DISTINCT size FROM items) WHERE len(ws) >= size)),
found AS (SELECT doc_id, item_id, d.size, p FROM doc_windows d JOIN item_windows i ON i.size = d.size AND i.w = d.w),
hits AS (SELECT doc_id, count(DISTINCT place) AS n FROM (SELECT doc_id, unnest(range(p, p + size)) AS place FROM found) GROUP BY doc_id),
names AS (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS listed
          FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS item FROM found) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, CAST(coalesce(h.n, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(i.n, 0) AS BIGINT) AS n_items, sha256(coalesce(i.listed, '')) AS items_sha256, coalesce(h.n, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hits h ON h.doc_id = d.doc_id LEFT JOIN names i ON i.doc_id = d.doc_id
"""

NEAR_LINES = """
WITH lines AS (
  SELECT doc_id, doc_id * 1000000 + no AS ord, line
  FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS line, unnest(range(len(string_split(text, chr(10))))) AS no
        FROM documents WHERE text IS NOT NULL)),
firsts AS (SELECT line, min(ord) AS ord, length(line) AS n FROM lines WHERE length(line) >= 20 GROUP BY line),
deletions AS (
  SELECT line, ord, i, hash(substr(line, 1, CAST(i - 1 AS INTEGER)) || substr(line, CAST(i + 1 AS INTEGER))) AS v
  FROM (SELECT *, unnest(range(1, n + 1)) AS i FROM firsts)),
pairs AS (SELECT d.line AS a, d.ord AS a_ord, f.line AS b, f.ord AS b_ord FROM deletions d JOIN firsts f ON hash(f.line) = d.v AND f.n >= 19),
near AS (
  SELECT line FROM (SELECT line, ord, min(ord) OVER (PARTITION BY v, i) AS least FROM deletions) WHERE least < ord
  UNION SELECT a FROM pairs WHERE b_ord < a_ord
  UNION SELECT b FROM pairs WHERE a_ord < b_ord),
marked AS (
  SELECT l.*, length(l.line) < 20 OR (l.ord = f.ord AND n.line IS NULL) AS stays
  FROM lines l LEFT JOIN firsts f ON f.line = l.line LEFT JOIN near n ON n.line = l.line),
cut AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (NOT stays) AS n_removed,
         string_agg(line, chr(10) ORDER BY ord) FILTER (stays) AS body
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, CAST(coalesce(n_lines, 0) AS BIGINT) AS n_lines, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(body, '')) AS kept_sha256
FROM documents d LEFT JOIN cut c ON c.doc_id = d.doc_id
"""

EQUAL_TEXTS = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
       doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM (SELECT doc_id, translate(coalesce(text, ''), '{_UPPER}', '{_LOWER}') AS body FROM documents)
WINDOW same AS (PARTITION BY body)
"""
