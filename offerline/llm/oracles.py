"""DuckDB SQL of the operators' queries that SQL can express."""

from __future__ import annotations

# Every sequence's own path keys, and each node's own value on its smallest
# member; a node's totals are its members' sums from its depth on.
OP11 = r"""
WITH own AS (
  SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS t, count(*) OVER (PARTITION BY conv_id) AS n,
    row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, sha256(strlen(coalesce(role, '')) || ' ' || coalesce(role, '') || coalesce(text, ''))[1:32]) AS pos
  FROM conversations WHERE conv_id IS NOT NULL),
crc_table AS (
  SELECT list(v ORDER BY i) AS tab FROM (
    SELECT i, list_reduce(list_prepend(i, range(8)), lambda a, k: CASE WHEN a % 2 = 1 THEN xor(a >> 1, 3988292384) ELSE a >> 1 END) AS v FROM range(256) r(i))),
plan AS (
  SELECT c, n, c - c % 20 AS b, xor(list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(c::VARCHAR, ''), lambda x: ascii(x)::BIGINT)),
    lambda a, x: xor(a >> 8, tab[xor(a, x) % 256 + 1])), 4294967295) % 4 AS h FROM (SELECT DISTINCT c, n FROM own), crc_table),
turns AS (
  SELECT p.c, d.pos AS i, d.r, d.t FROM plan p JOIN own d ON d.c = p.b AND d.pos <= p.h
  UNION ALL
  SELECT p.c, o.pos - p.h + least(p.h, coalesce((SELECT max(n) FROM own d WHERE d.c = p.b), 0)), o.r, o.t
  FROM plan p JOIN own o ON o.c = p.c AND o.pos > p.h),
places AS (
  SELECT c, i, sha256(string_agg(strlen(r) || ' ' || r || strlen(t) || ' ' || t, '' ORDER BY i) OVER (PARTITION BY c ORDER BY i)) AS node,
    len(regexp_extract_all(t, '[^\x20\x09-\x0D]+')) AS w FROM turns
  UNION ALL
  SELECT c, 0, '', 0 FROM plan),
linked AS (
  SELECT *, lag(node) OVER (PARTITION BY c ORDER BY i) AS parent, max(i) OVER (PARTITION BY c) = i AS is_end FROM places),
nodes AS (
  SELECT node, min(c) AS conv_id, any_value(i) AS depth, any_value(parent) AS parent, count(*) AS n_convs, any_value(w) AS w,
    sha256(coalesce(string_agg(CASE WHEN is_end THEN c::VARCHAR END, ',' ORDER BY c), '')) AS ends_sha256 FROM linked GROUP BY node),
kids AS (SELECT parent AS node, count(*) AS n_children FROM nodes WHERE parent IS NOT NULL GROUP BY parent),
full_nodes AS (SELECT nodes.*, coalesce(n_children, 0) AS n_children FROM nodes LEFT JOIN kids USING (node)),
sums AS (
  SELECT l.node, sum(CASE WHEN f.n_children = 0 THEN 1 ELSE 0 END) OVER s AS leaves, sum(coalesce((f.n_convs - 1) * f.w, 0)) OVER s AS saved
  FROM linked l LEFT JOIN full_nodes f ON f.conv_id = l.c AND f.depth = l.i
  WINDOW s AS (PARTITION BY l.c ORDER BY l.i DESC)),
totals AS (SELECT node, sum(leaves) AS n_leaves, sum(saved) AS saved_tokens FROM sums GROUP BY node)
SELECT f.conv_id, f.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, f.n_convs::BIGINT AS n_convs, f.n_children::BIGINT AS n_children,
  n_leaves::BIGINT AS n_leaves, saved_tokens::BIGINT AS saved_tokens, f.ends_sha256
FROM full_nodes f JOIN totals USING (node) LEFT JOIN full_nodes p ON p.node = f.parent
"""

# Every pair of sources over every kept term, zero counts included.
OP13 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
words AS (SELECT id, lang, source, unnest(regexp_extract_all(t, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs),
kept AS (SELECT lang, term, count(*) AS total FROM words GROUP BY lang, term HAVING count(DISTINCT id) >= 10),
counts AS (SELECT lang, source, term, count(*) AS n FROM words SEMI JOIN kept USING (lang, term) GROUP BY ALL),
langs AS (SELECT lang, count(*) AS v, sum(total) AS lang_n FROM kept GROUP BY lang),
sources AS (SELECT DISTINCT lang, source FROM docs),
sums AS (SELECT lang, source, sum(n) AS group_n FROM counts GROUP BY ALL),
cells AS (
  SELECT s.lang, s.source, k.term, coalesce(c.n, 0) AS n,
    1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (coalesce(m.group_n, 0) + 2 * l.v) AS p,
    1 + (1000000000::HUGEINT * (k.total + 2)) // (l.lang_n + 2 * l.v) AS q
  FROM sources s JOIN langs l USING (lang) JOIN kept k USING (lang) LEFT JOIN sums m USING (lang, source) LEFT JOIN counts c USING (lang, source, term)),
pairs AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM cells a JOIN cells b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
found AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(p.value, 0) AS value
  FROM sources a JOIN sources b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN pairs p ON p.lang = a.lang AND p.source = a.source AND p.item = b.source
  UNION ALL
  SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM cells WHERE n > 0 AND p > q)
SELECT lang, source, part, item, value::BIGINT AS value,
  row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INTEGER AS rank
FROM found QUALIFY part = 'pair' OR rank <= 10
"""
