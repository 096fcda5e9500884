"""License scan against brute force, and inheritance by path."""

from __future__ import annotations

import math
from collections import Counter

from shelfspark.llm import license_scan as S
from shelfspark.llm.line_dedup import SIGNS


def words(t):
    return [w for w in (x.strip(SIGNS) for x in (t or "").lower().split()) if w]


def passages(text):
    """Lines, whole text, and windows of every template's length."""
    lines, all_words = (text or "").split("\n"), words(text)
    yield from map(words, [*lines, text or ""])
    for n in {len(words(t)) for kind in (S.TEMPLATES, S.TITLES) for ts in kind.values() for t in ts}:
        for i in range(len(all_words) - n + 1):
            yield all_words[i : i + n]


def brute(rows):
    """{doc: rounded cosine} of every passage against every template."""
    templates = [words(t) for kind in (S.TEMPLATES, S.TITLES) for ts in kind.values() for t in ts]
    known = {w for ws in templates for w in ws}
    df = Counter(w for _, t in rows for w in set(words(t)) & known)
    idf = {w: math.log((2 + len(rows)) / (1 + df[w])) for w in known}
    other = math.log(2 + len(rows))

    def cosine(ws, ts):
        a, b = Counter(w for w in ws if w in known), Counter(ts)
        na = sum((n * idf[w]) ** 2 for w, n in a.items()) + sum(other**2 for w in ws if w not in known)
        nb = sum((n * idf[w]) ** 2 for w, n in b.items())
        return sum(n * b[w] * idf[w] ** 2 for w, n in a.items()) / math.sqrt(na * nb) if na and nb else 0.0

    best = {d: max(cosine(p, ts) for p in passages(t) for ts in templates) for d, t in rows}
    return {d: round(c, 9) if c >= 0.8 else None for d, c in best.items()}


def test_licenses(spark):
    filler = "some words that are not about it at all\nand more"
    mit, bsd = S.TEMPLATES["MIT"][-1], S.TEMPLATES["BSD-3-Clause"][-1]
    apache, title = S.TEMPLATES["Apache-2.0"][-1], S.TITLES["Apache-2.0"][0]
    header = "\n".join("# " + line for line in apache.strip().split("\n"))
    files = [
        (1, "a/LICENSE", "Released under the MIT License."),
        (2, "a/b/c/x.txt", filler),
        (3, "a/b/COPYING", "Licensed under the Apache License, Version 2.0."),
        (4, "a/y.txt", filler + "\nThis work is licensed under the GNU General Public License, version 3."),
        (5, "z/q.txt", filler),
        (6, None, filler),
        (7, "a/empty", None),
        (8, "z/part", "see CC BY-NC 4.0 " + filler.replace("\n", " ")),
        (9, "a/b/c/x.txt", filler),
        (10, "m/LICENSE", "MIT License\n\nCopyright (c) 2020 Some One\n" + mit),
        (11, "m/src/deep/q.c", filler),
        (12, "p/LICENSE.txt", title + filler * 30),
        (13, "p/src/q.c", filler),
        (14, "q/wrapped.c", filler + "\n/* Released\n * under the\n * MIT License */\n" + filler * 9),
        (15, "q/long.c", filler.replace("\n", " ") * 9 + " Released under the MIT License. " + filler * 9),
        (16, "q/none.c", filler),
        (17, "r/COPYING", "Copyright 2021 Some One. All rights reserved.\n" + bsd),
        (18, "r/a/q.c", None),
        (19, "s/head.py", header + "\n" + filler * 20),
        (20, "s/other.py", filler),
    ]
    df = spark.createDataFrame([(*f, "x", 1.0) for f in files], "doc_id long, path string, text string, license string, cosine double")
    got = {r["doc_id"]: r for r in S.license_scan(df, "path", "doc_id").collect()}
    want = brute([(d, t) for d, _, t in files])
    assert {d: round(r["cosine"], 9) if r["own_license"] else None for d, r in got.items()} == want
    assert {d: (r["license"], r["inherited_from"]) for d, r in got.items()} == {
        1: ("MIT", None), 2: ("Apache-2.0", "a/b"), 3: ("Apache-2.0", None), 4: ("GPL-3.0", None), 5: (None, None),
        6: (None, None), 7: ("MIT", "a"), 8: (None, None), 9: ("Apache-2.0", "a/b"),
        10: ("MIT", None), 11: ("MIT", "m"), 12: ("Apache-2.0", None), 13: ("Apache-2.0", "p"),
        14: ("MIT", None), 15: ("MIT", None), 16: (None, None), 17: ("BSD-3-Clause", None), 18: ("BSD-3-Clause", "r"),
        19: ("Apache-2.0", None), 20: (None, None),
    }
    assert S.license_scan(df.where("doc_id < 0"), "path", "doc_id").count() == 0
