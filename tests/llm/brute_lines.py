"""A plain second version of the line dedup: the edit distance of all pairs of different lines; knows no keys."""

from itertools import combinations

SIGNS = ".,;:!?\"'()[]{}<>*#$%&|/\\-_=+~`^@"


def plain_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(old[j] + 1, row[-1] + 1, old[j - 1] + (x != y)))
    return row[-1]


def within(a, b, most):
    """Whether the distance is at most that: the table's cells near its diagonal, row by row."""
    far = most + 1
    row = {j: j for j in range(min(most, len(b)) + 1)}
    for i, x in enumerate(a, 1):
        old, row = row, {}
        for j in range(max(0, i - most), min(len(b), i + most) + 1):
            best = min(old.get(j, far) + 1, row.get(j - 1, far) + 1, old.get(j - 1, far) + (x != b[j - 1])) if j else i
            if best < far:
                row[j] = best
        if not row:
            return False
    return row.get(len(b), far) <= most


def normal(line):
    return " ".join(w for w in (x.strip(SIGNS) for x in line.lower().split()) if w)


def dedup(rows):
    """rows: (doc_id, text) with different doc_ids; returns {doc_id: text}."""
    spots = {}
    for d, t in sorted(rows):
        for i, line in enumerate((t or "").split("\n")):
            if n := normal(line):
                spots.setdefault(n, []).append((d, i))
    lines = list(spots)
    parent = list(range(len(lines)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in combinations(range(len(lines)), 2):
        a, b = lines[i], lines[j]
        most = int(0.1 * max(len(a), len(b)) + 1e-9)
        if abs(len(a) - len(b)) <= most and within(a, b, most):
            parent[find(i)] = find(j)
    groups = {}
    for i, x in enumerate(lines):
        groups.setdefault(find(i), []).extend(spots[x])
    gone = {s for g in groups.values() for s in sorted(g)[1:]}
    return {
        d: t if not any(d == x for x, _ in gone) else "\n".join(x for i, x in enumerate((t or "").split("\n")) if (d, i) not in gone)
        for d, t in rows
    }
