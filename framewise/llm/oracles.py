"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

_TRIM = r"trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13))"

OP2 = rf"""
WITH lines AS (
  SELECT doc_id, source, text, unnest(string_split(text, chr(10))) AS line,
         generate_subscripts(string_split(text, chr(10)), 1) AS pos
  FROM documents),
judged AS (
  SELECT doc_id, source, pos, {_TRIM} AS t,
         len(string_split_regex({_TRIM}, '[\x20\x09-\x0D]+')) >= 5
           OR strlen({_TRIM}) - length({_TRIM}) >= 40 AS long FROM lines),
bad AS (
  SELECT t, min(doc_id) AS owner FROM judged WHERE long GROUP BY t HAVING count(DISTINCT source) >= 5),
marked AS (
  SELECT l.doc_id, l.pos, l.line, (j.long AND b.t IS NOT NULL AND b.owner <> l.doc_id) AS gone
  FROM lines l JOIN judged j USING (doc_id, pos) LEFT JOIN bad b ON j.t = b.t),
cut AS (
  SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_removed,
         coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '') AS text
  FROM marked GROUP BY doc_id)
SELECT d.doc_id, c.text, coalesce(c.n_lines, 0) AS n_lines, coalesce(c.n_removed, 0) AS n_removed
FROM documents d LEFT JOIN cut c USING (doc_id)
"""

_LOWER = "translate({0}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = r"regexp_extract_all(" + _LOWER + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

OP4 = rf"""
WITH doc AS (
  SELECT doc_id, coalesce({_WORDS.format('text')}, []) AS w FROM documents),
item AS (
  SELECT item_id, {_WORDS.format('text')} AS w FROM benchmark),
pattern AS (
  SELECT DISTINCT item_id, m, w[i:i + m - 1] AS p FROM (
    SELECT item_id, w, least(10, len(w)) AS m, unnest(range(1, len(w) - least(10, len(w)) + 2)) AS i
    FROM item WHERE len(w) > 0)),
lengths AS (SELECT DISTINCT m FROM pattern),
grams AS (
  SELECT doc_id, m, i, w[i:i + m - 1] AS p FROM (
    SELECT doc_id, w, m, unnest(range(1, len(w) - m + 2)) AS i FROM doc, lengths WHERE len(w) >= m)),
hits AS (SELECT g.doc_id, g.i, g.m, p.item_id FROM grams g JOIN pattern p USING (m, p)),
words AS (
  SELECT doc_id, count(DISTINCT j) AS n_hit FROM (
    SELECT doc_id, unnest(range(i, i + m)) AS j FROM hits) GROUP BY doc_id),
items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS id FROM hits) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM doc LEFT JOIN words USING (doc_id) LEFT JOIN items USING (doc_id)
"""


OP11 = r"""
WITH turn_rows AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), coalesce(text, '')) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
conv AS (
  SELECT conv_id, count(*) AS n, conv_id - conv_id % 5 AS base, xor(list_reduce(
    list_concat([4294967295], list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
    lambda crc, b: list_reduce(list_concat([xor(crc, b)], range(8)),
                               lambda v, i: xor(v >> 1, 3988292384 * (v & 1)))), 4294967295) % 9 AS h
  FROM turn_rows GROUP BY conv_id),
plan AS (
  SELECT c.*, least(c.h, coalesce(b.n, 0)) AS got FROM conv c LEFT JOIN conv b ON b.conv_id = c.base),
built AS (
  SELECT p.conv_id, t.pos, t.role, t.text FROM plan p JOIN turn_rows t ON t.conv_id = p.base AND t.pos <= p.h
  UNION ALL
  SELECT p.conv_id, t.pos - p.h + p.got, t.role, t.text FROM plan p JOIN turn_rows t USING (conv_id) WHERE t.pos > p.h),
-- Every member's prefixes: the turns in order, with lengths so that no two sequences are written alike.
paths AS (
  SELECT conv_id, pos AS depth, octet_length(encode(text)) AS size, string_agg(
           length(role) || ':' || length(text) || ':' || role || text, '|') OVER (
           PARTITION BY conv_id ORDER BY pos ROWS UNBOUNDED PRECEDING) AS path
  FROM built
  UNION ALL SELECT conv_id, 0, 0, '' FROM plan),
lengths AS (SELECT conv_id, max(depth) AS len FROM paths GROUP BY conv_id),
nodes AS (
  SELECT depth, path, min(conv_id) AS conv_id, count(*) AS n_convs, max(size) AS size,
         count(*) FILTER (depth = len) AS n_ends,
         coalesce(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id) FILTER (depth = len), '') AS ends
  FROM paths JOIN lengths USING (conv_id) GROUP BY depth, path),
-- A node's ancestors are the prefixes of its smallest member.
above AS (
  SELECT n.conv_id, n.depth, n.n_convs, n.size, n.n_ends, p.depth AS up, p.path AS up_path
  FROM nodes n JOIN paths p ON p.conv_id = n.conv_id AND p.depth <= n.depth),
below AS (
  SELECT up AS depth, up_path AS path, count(*) FILTER (above.depth = up + 1) AS n_children,
         count(*) FILTER (n_convs = n_ends) AS n_leaves, sum((n_convs - 1) * size)::BIGINT AS saved_tokens
  FROM above GROUP BY up, up_path)
SELECT n.conv_id, n.depth, m.conv_id AS parent_conv_id, n.n_convs, b.n_children, b.n_leaves, b.saved_tokens,
       sha256(n.ends) AS ends_sha256
FROM nodes n JOIN below b USING (depth, path)
LEFT JOIN paths p ON p.conv_id = n.conv_id AND p.depth = n.depth - 1
LEFT JOIN nodes m ON m.depth = p.depth AND m.path = p.path
"""

OP12 = r"""
WITH cut AS (
  SELECT doc_id, coalesce(text, '') AS text, sha256('42:' || coalesce(doc_id::VARCHAR, '')) AS h,
         regexp_extract_all(coalesce(text, ''), '[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+') AS u
  FROM documents),
drawn AS (
  SELECT doc_id, text, u, len(u) AS n, ('0x' || h[1:8])::BIGINT % (len(u) + 1) AS x,
         ('0x' || h[9:16])::BIGINT % (len(u) + 1) AS y, ('0x' || h[17:24])::BIGINT % 100 AS c,
         ('0x' || h[25:32])::BIGINT % 100 AS o
  FROM cut),
parts AS (
  SELECT *, array_to_string(u[1:least(x, y)], '') AS p, array_to_string(u[least(x, y) + 1:greatest(x, y)], '') AS m,
         array_to_string(u[greatest(x, y) + 1:], '') AS s,
         CASE WHEN text = '' OR contains(text, '<P>') OR contains(text, '<S>') OR contains(text, '<M>') OR c >= 50
              THEN 'plain' WHEN o < 80 THEN 'spm' ELSE 'psm' END AS form
  FROM drawn)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
                        ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""


def oracle_sql() -> dict[str, str]:
    return {"op2_line_spread": OP2, "op4_wu_manber": OP4, "op11_turn_trie": OP11, "op12_fim_swar": OP12}
