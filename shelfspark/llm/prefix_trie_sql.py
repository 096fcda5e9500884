"""DuckDB twin of op11_prefix_trie: all prefixes written out, subtrees by a join with all ancestors."""

from .sql_parts import crc32

ORACLE_SQL = rf"""
WITH t AS (SELECT conv_id AS c, coalesce(role, '') AS r, coalesce(text, '') AS x, turn FROM conversations WHERE conv_id IS NOT NULL),
i AS (SELECT c, turn, md5(strlen(r) || ':' || r || x) AS id, len(regexp_extract_all(x, '[^\x20\x09-\x0D]+')) AS w FROM t),
p AS (SELECT c, id, w, row_number() OVER (PARTITION BY c ORDER BY turn NULLS FIRST, id) AS pos FROM i),
convs AS (SELECT c, {crc32("c::VARCHAR")} % 4 AS h, c - c % 20 AS base FROM (SELECT DISTINCT c FROM p)),
heads AS (SELECT v.c, p.pos AS a, 0 AS part, p.id, p.w FROM convs v JOIN p ON p.c = v.base AND p.pos <= v.h),
rests AS (SELECT v.c, p.pos AS a, 1 AS part, p.id, p.w FROM convs v JOIN p ON p.c = v.c AND p.pos > v.h),
rebuilt AS (SELECT c, id, w, row_number() OVER (PARTITION BY c ORDER BY part, a) AS d FROM (SELECT * FROM heads UNION ALL SELECT * FROM rests)),
paths AS (SELECT c, d, w, md5(string_agg(id, ',') OVER (PARTITION BY c ORDER BY d)) AS k, lag(d) OVER (PARTITION BY c ORDER BY d) AS before, count(*) OVER (PARTITION BY c) AS n FROM rebuilt),
every AS (SELECT c, d, w, k, n FROM paths UNION ALL SELECT v.c, 0, 0, '', coalesce((SELECT max(d) FROM rebuilt r WHERE r.c = v.c), 0) FROM convs v),
nodes AS (SELECT d, k, min(c) AS c, count(*) AS n_convs, any_value(w) AS w, max(n) = d AS leaf,
  sha256(coalesce(string_agg(c::VARCHAR, ',' ORDER BY c) FILTER (WHERE n = d), '')) AS ends FROM every GROUP BY d, k),
up AS (SELECT u.d, u.k, u.c, u.n_convs, u.w, u.leaf, e.d AS ad, e.k AS ak FROM nodes u JOIN every e ON e.c = u.c AND e.d <= u.d),
sums AS (SELECT ad, ak, sum((n_convs - 1) * w) AS saved, sum(leaf::INT) AS leaves, sum((d = ad + 1)::INT) AS children FROM up GROUP BY ad, ak),
parents AS (SELECT up.d, up.k, n.c AS parent FROM up JOIN nodes n ON n.d = up.ad AND n.k = up.ak WHERE up.ad = up.d - 1)
SELECT n.c AS conv_id, n.d::BIGINT AS depth, q.parent AS parent_conv_id, n.n_convs::BIGINT AS n_convs, s.children::BIGINT AS n_children,
  s.leaves::BIGINT AS n_leaves, s.saved::BIGINT AS saved_tokens, n.ends AS ends_sha256
FROM nodes n JOIN sums s ON s.ad = n.d AND s.ak = n.k LEFT JOIN parents q ON q.d = n.d AND q.k = n.k
"""
