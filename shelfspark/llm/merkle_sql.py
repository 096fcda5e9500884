"""DuckDB twin of op13_merkle, for at most 16**5 rows a source and 16**3 sources."""

from .sql_parts import crc32

DOC_LEVELS, SOURCE_LEVELS = 5, 3


def _encoded(text: str) -> str:
    fields = ["doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text]
    return " || ".join(f"coalesce(strlen({f}) || ':' || {f}, '-')" for f in fields)


def _level(name: str, keys: str) -> str:
    """Each node with the text of its run left and right of it, its run's hash, and the next round's place and number."""
    over = f"OVER (PARTITION BY {keys} pos // 16 ORDER BY pos ROWS BETWEEN"
    return f"""{name}_s AS (SELECT *, coalesce(string_agg(h, '') {over} UNBOUNDED PRECEDING AND 1 PRECEDING), '') AS lft,
  coalesce(string_agg(h, '') {over} 1 FOLLOWING AND UNBOUNDED FOLLOWING), '') AS rgt FROM {name})"""


def _tree(name: str, keys: str, levels: int) -> list[str]:
    parts = []
    for i in range(levels):
        parts.append(_level(f"{name}{i}", keys))
        parts.append(
            f"{name}{i + 1} AS (SELECT {keys} pos // 16 AS pos, if(n = 1, any_value(h), sha256(string_agg(h, '' ORDER BY pos))) AS h, "
            f"(n + 15) // 16 AS n FROM {name}{i} GROUP BY {keys} pos // 16, n)"
        )
    return parts


def _climb(start: str, tree: str, keys: list[str], levels: int) -> list[str]:
    """Steps that carry node, proof and folded hash up a tree."""
    parts, last = [], start
    for i in range(levels):
        name = f"{tree}_up{i}"
        on = " AND ".join([*[f"f.{k} = t.{k}" for k in keys], f"t.pos = f.place // {16**i}"])
        parts.append(
            f"{name} AS (SELECT f.* REPLACE (f.proof || if(t.n = 1, '', t.lft || t.rgt) AS proof, if(t.n = 1, f.fold, sha256(t.lft || f.fold || t.rgt)) AS fold) "
            f"FROM {last} f JOIN {tree}{i}_s t ON {on})"
        )
        last = name
    return parts


ORACLE_SQL = (
    f"""
WITH r AS (SELECT doc_id, coalesce('s' || source, '') AS k, sha256({_encoded("text")}) AS leaf,
  if({crc32("doc_id::VARCHAR")} % 5 = 0, sha256({_encoded("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")}), NULL) AS changed FROM documents),
o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY doc_id NULLS FIRST, leaf) - 1 AS place, count(*) OVER (PARTITION BY k) AS n FROM r),
a0 AS (SELECT k, place AS pos, leaf AS h, n FROM o),
"""
    + ",\n".join(_tree("a", "k,", DOC_LEVELS))
    + f""",
tops AS (SELECT k, h, row_number() OVER (ORDER BY k) - 1 AS pos, count(*) OVER () AS n FROM a{DOC_LEVELS}),
b0 AS (SELECT pos, h, n FROM tops),
"""
    + ",\n".join(_tree("b", "", SOURCE_LEVELS))
    + """,
start AS (SELECT doc_id, k, leaf, place, '' AS proof, coalesce(changed, leaf) AS fold FROM o),
"""
    + ",\n".join(_climb("start", "a", ["k"], DOC_LEVELS))
    + f""",
middle AS (SELECT f.* REPLACE (t.pos AS place), t.h AS subroot FROM a_up{DOC_LEVELS - 1} f JOIN tops t USING (k)),
"""
    + ",\n".join(_climb("middle", "b", [], SOURCE_LEVELS))
    + f"""
SELECT doc_id, leaf, subroot, b{SOURCE_LEVELS}.h AS root, sha256(proof) AS proof_sha256, fold AS folded_root, fold = b{SOURCE_LEVELS}.h AS verified
FROM b_up{SOURCE_LEVELS - 1}, b{SOURCE_LEVELS}
"""
)
