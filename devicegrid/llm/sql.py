"""DuckDB SQL for the registered queries that SQL can express."""

from __future__ import annotations

OP1 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -1, 0, 'user', '</s>[INST] ok [/INST]'
  UNION ALL SELECT -1, 1, 'assistant', '</s>[INST] ok [/INST]'
), marked AS (
  SELECT *,
    lag(role, 1, '') OVER (PARTITION BY conv_id ORDER BY turn, role, text) AS was,
    length(text) + 4 * (length(text) - length(replace(text, '&', '')))
      + 4 * len(regexp_extract_all(text, '<s>|</s>|<<SYS>>|<</SYS>>|<\|im_start\|>|<\|im_end\|>|<\|endoftext\|>|\[INST\]|\[/INST\]'))
      + length('<|im_start|>') + length(role) + 1 + length('<|im_end|>') + 1 AS chars
  FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
  length(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
  (sum(chars) + length('<s>') + length('</s>'))::BIGINT AS formatted_chars,
  bool_and(CASE role WHEN 'system' THEN was = '' WHEN 'user' THEN was IN ('', 'system', 'assistant')
           WHEN 'assistant' THEN was = 'user' ELSE false END)
    AND max_by(role, (turn, role, text)) IN ('user', 'assistant') AS valid
FROM marked GROUP BY conv_id
"""

OP5 = """
WITH texts AS (SELECT doc_id, coalesce(text, '') AS body FROM documents)
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, sha256(body) AS text_sha256
FROM texts WINDOW same AS (PARTITION BY body)
"""

#: CTEs: words of documents and items, distinct windows of items, and hits.
_CONTAMINATION = r"""
docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {documents}
), items AS (
  SELECT coalesce(item_id::VARCHAR, '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM benchmark
), item_windows AS (
  SELECT DISTINCT item, least(10, len(words)) AS size, array_to_string(words[i:i + least(10, len(words)) - 1], ' ') AS win
  FROM items, unnest(range(1, len(words) - least(10, len(words)) + 2)) AS r(i) WHERE len(words) > 0
), sizes AS (SELECT DISTINCT size FROM item_windows),
doc_windows AS (
  SELECT doc_id, size, i, array_to_string(words[i:i + size - 1], ' ') AS win
  FROM docs, sizes, unnest(range(1, len(words) - size + 2)) AS r(i) WHERE len(words) >= size
), hits AS (SELECT doc_id, size, i, item FROM doc_windows JOIN item_windows USING (size, win)
), covered AS (
  SELECT doc_id, count(DISTINCT i + k) AS n FROM (SELECT DISTINCT doc_id, size, i FROM hits), unnest(range(size)) AS r(k) GROUP BY doc_id
)"""

OP8 = "WITH " + _CONTAMINATION.replace("{documents}", "documents") + """
SELECT d.doc_id, len(d.words) AS n_words, coalesce(c.n, 0) AS n_hit, coalesce(h.n, 0) AS n_items,
  sha256(coalesce(h.ids, '')) AS items_sha256, c.n IS NOT NULL AS contaminated
FROM docs d LEFT JOIN covered c USING (doc_id)
LEFT JOIN (SELECT doc_id, count(*) AS n, string_agg(item, ',' ORDER BY item) AS ids
           FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id) h USING (doc_id)
"""

#: CTEs: shingles by document, texts with equal sets as nodes, links and classes.
_NEAR = r"""
word_lists AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS words FROM {documents}
), sets AS (
  SELECT doc_id, list_sort(list_distinct(list_transform(range(1, len(words) - least(5, len(words)) + 2),
    lambda i: array_to_string(words[i:i + least(5, len(words)) - 1], ' ')))) AS grams FROM word_lists WHERE len(words) > 0
), nodes AS (
  SELECT min(doc_id) AS node, any_value(grams) AS grams, count(*) AS copies, list(doc_id) AS ids FROM sets GROUP BY sha256(array_to_string(grams, chr(10)))
), flat AS (SELECT node, len(grams) AS n, unnest(grams) AS gram FROM nodes),
links AS (
  SELECT a.node AS a, b.node AS b FROM flat a JOIN flat b ON a.gram = b.gram AND a.node <> b.node
  GROUP BY a.node, b.node, a.n, b.n HAVING count(*) >= 0.8 * (a.n + b.n - count(*)) - 1e-9
), reached AS (
  SELECT node AS a, node AS b FROM nodes UNION SELECT r.a, l.b FROM reached r JOIN links l ON r.b = l.a
), classes AS (SELECT a AS node, min(b) AS class_id FROM reached GROUP BY a
), linked AS (SELECT l.a AS node, sum(n.copies) AS n, count(*) AS texts FROM links l JOIN nodes n ON n.node = l.b GROUP BY l.a
), near AS (
  SELECT unnest(n.ids) AS doc_id, c.class_id, coalesce(l.n, 0) + n.copies - 1 AS n_links, coalesce(l.texts, 0) AS n_texts,
    sum(n.copies) OVER (PARTITION BY c.class_id) AS class_rows
  FROM nodes n JOIN classes c USING (node) LEFT JOIN linked l USING (node)
)"""

OP7 = "WITH RECURSIVE " + _NEAR.replace("{documents}", "documents") + """
SELECT d.doc_id, coalesce(n.class_id, d.doc_id) AS class_id, coalesce(n.n_links, 0)::BIGINT AS n_links,
  coalesce(n.n_texts, 0)::BIGINT AS n_texts, coalesce(n.class_rows, 1)::BIGINT AS class_rows
FROM documents d LEFT JOIN near n USING (doc_id)
"""

#: CRC-32 of the decimal id, bit by bit; paths as lists of (role, text).
OP11 = r"""
WITH turns AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL
), convs AS (
  SELECT conv_id, conv_id - conv_id % 5 AS base, xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda ch: ascii(ch)::BIGINT)),
    lambda c, b: list_reduce(list_prepend(xor(c, b), [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
                             lambda x, y: xor(x >> 1, 3988292384::BIGINT * (x & 1))))) % 9 AS h
  FROM (SELECT DISTINCT conv_id FROM turns)
), sizes AS (
  SELECT c.conv_id, c.base, c.h, least(c.h, count(t.pos)) AS taken FROM convs c LEFT JOIN turns t ON t.conv_id = c.base GROUP BY c.conv_id, c.base, c.h
), rebuilt AS (
  SELECT s.conv_id, t.pos AS d, t.role, t.text FROM sizes s JOIN turns t ON t.conv_id = s.base AND t.pos <= s.h
  UNION ALL SELECT s.conv_id, s.taken + t.pos - s.h, t.role, t.text FROM sizes s JOIN turns t ON t.conv_id = s.conv_id AND t.pos > s.h
), paths AS (
  SELECT conv_id, d, text, list({'r': role, 't': text}) OVER (PARTITION BY conv_id ORDER BY d) AS path, count(*) OVER (PARTITION BY conv_id) AS n FROM rebuilt
  UNION ALL SELECT c.conv_id, 0, '', [], (SELECT count(*) FROM rebuilt r WHERE r.conv_id = c.conv_id) FROM convs c
), nodes AS (
  SELECT min(conv_id) AS conv_id, d AS depth, path, count(*) AS n_convs, (count(*) - 1) * strlen(any_value(text)) AS gain,
    sha256(coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (n = d), '')) AS ends_sha256
  FROM paths GROUP BY d, path
), children AS (SELECT path[1:depth - 1] AS path, depth - 1 AS depth, count(*) AS n FROM nodes WHERE depth > 0 GROUP BY 1, 2
), subtrees AS (
  SELECT a.depth, a.path, count(*) FILTER (c.n IS NULL) AS n_leaves, sum(b.gain)::BIGINT AS saved
  FROM nodes a JOIN nodes b ON b.depth >= a.depth AND b.path[1:a.depth] = a.path LEFT JOIN children c ON c.depth = b.depth AND c.path = b.path
  GROUP BY a.depth, a.path
)
SELECT n.conv_id, n.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, n.n_convs, coalesce(c.n, 0)::BIGINT AS n_children, s.n_leaves, s.saved AS saved_tokens, n.ends_sha256
FROM nodes n JOIN subtrees s ON s.depth = n.depth AND s.path = n.path LEFT JOIN children c ON c.depth = n.depth AND c.path = n.path
LEFT JOIN nodes p ON p.depth = n.depth - 1 AND p.path = n.path[1:n.depth - 1]
"""

ORACLE_SQL = {"op1_chat_format": OP1, "op5_exact_dedup": OP5, "op7_ngram_jaccard_join": OP7, "op8_decontamination": OP8, "op11_prefix_trie": OP11}
