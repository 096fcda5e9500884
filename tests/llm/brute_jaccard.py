"""Components of the Jaccard join by testing every pair that shares a shingle."""

import re
from collections import defaultdict

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingle_set(text):
    w = re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4)))


def groups(rows):
    """rows: (doc_id, text); returns sorted (doc_id, n_shingles, component_id)."""
    sets = [(d, shingle_set(t)) for d, t in rows]
    by, parent = defaultdict(list), list(range(len(sets)))
    for i, (_, s) in enumerate(sets):
        for x in s:
            by[x].append(i)

    def find(i):
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    tried = set()
    for members in by.values():
        for k, i in enumerate(members):
            for j in members[:k]:
                if (j, i) not in tried:
                    tried.add((j, i))
                    a, b = sets[i][1], sets[j][1]
                    shared = len(a & b)
                    if 100 * shared >= 75 * (len(a) + len(b) - shared):
                        parent[find(i)] = find(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        if d is not None:
            r = find(i)
            least[r] = min(least.get(r, d), d)
    return sorted(((d, len(s), least.get(find(i), d) if s else d) for i, (d, s) in enumerate(sets)), key=repr)
