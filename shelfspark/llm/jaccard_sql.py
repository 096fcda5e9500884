"""DuckDB SQL for the rows of ``op2_jaccard_join``: all pairs of sets that share a shingle, and their closure."""

ORACLE_SQL = r"""
WITH RECURSIVE words AS MATERIALIZED (
    SELECT row_number() OVER () AS rid, doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x20\x09-\x0D]+') AS w
    FROM documents
),
placed AS (SELECT rid, unnest(w) AS a, generate_subscripts(w, 1) AS place FROM words WHERE len(w) >= 5),
windows AS (
    SELECT rid, a || ' ' || lead(a) OVER o || ' ' || lead(a, 2) OVER o || ' ' || lead(a, 3) OVER o || ' ' || lead(a, 4) OVER o AS item
    FROM placed WINDOW o AS (PARTITION BY rid ORDER BY place)
),
long_sets AS (SELECT rid, list(item ORDER BY item) AS s FROM (SELECT DISTINCT rid, item FROM windows WHERE item IS NOT NULL) GROUP BY rid),
sets AS MATERIALIZED (
    SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 5 THEN [array_to_string(w, ' ')] ELSE s END AS s
    FROM words LEFT JOIN long_sets USING (rid)
),
classes AS MATERIALIZED (
    SELECT row_number() OVER () AS node, s, len(s) AS n, min(doc_id) AS first FROM sets WHERE len(s) > 0 GROUP BY s
),
items AS MATERIALIZED (SELECT node, n, unnest(s) AS item FROM classes),
links AS MATERIALIZED (
    SELECT x.node AS a, y.node AS b
    FROM items x JOIN items y ON x.item = y.item AND x.node <> y.node
    GROUP BY x.node, y.node, x.n, y.n
    HAVING 100 * count(*) >= 75 * (x.n + y.n - count(*))
),
reach AS (
    SELECT node, node AS other FROM classes
    UNION
    SELECT r.node, l.b FROM reach r JOIN links l ON r.other = l.a
),
components AS (
    SELECT r.node, min(c.first) AS component FROM reach r JOIN classes c ON c.node = r.other GROUP BY r.node
)
SELECT d.doc_id, CAST(len(d.s) AS BIGINT) AS n_shingles, coalesce(k.component, d.doc_id) AS component_id
FROM sets d LEFT JOIN classes c ON d.s = c.s LEFT JOIN components k ON k.node = c.node
"""
