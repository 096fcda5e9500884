"""A plain second version of the Merkle manifest, for tests."""

import hashlib
import zlib
from collections import defaultdict

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf(fields):
    return sha("".join("-" if f is None else f"{len(str(f).encode())}:{f}" for f in fields))


def tree(nodes):
    """Root, and of each node the siblings with the numbers left and right on every level."""
    paths, at = [([], []) for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, (siblings, shape) in enumerate(paths):
            low = at[i] // 16 * 16
            run = nodes[low : low + 16]
            siblings += [h for j, h in enumerate(run) if low + j != at[i]]
            shape.append((at[i] - low, low + len(run) - 1 - at[i]))
            at[i] //= 16
        nodes = [sha("".join(nodes[i : i + 16])) for i in range(0, len(nodes), 16)]
    return nodes[0], paths


def fold(node, siblings, shape):
    siblings = list(siblings)
    for left, right in shape:
        run = siblings[: left + right]
        siblings = siblings[left + right :]
        node = sha("".join([*run[:left], node, *run[left:]]))
    return node


def rows(docs):
    """docs: (doc_id, source, lang, n_chars, text). Sorted tuples of the query's columns."""
    groups = defaultdict(list)
    for d in docs:
        groups[d[1]].append(d)
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    made = {}
    for s in names:
        own = sorted(groups[s], key=lambda d: (d[0] is not None, d[0] or 0, leaf(d)))
        made[s] = own, *tree([leaf(d) for d in own])
    if not made:
        return []
    root, above = tree([made[s][1] for s in names])
    out = []
    for s, (far, far_shape) in zip(names, above, strict=True):
        own, subroot, paths = made[s]
        for d, (siblings, shape) in zip(own, paths, strict=True):
            tampered = d[0] is not None and zlib.crc32(str(d[0]).encode()) % 5 == 0
            node = leaf((*d[:4], d[4] and d[4].translate(LOWER))) if tampered else leaf(d)
            found = fold(node, siblings + far, shape + far_shape)
            out.append((d[0], leaf(d), subroot, root, sha("".join(siblings + far)), found, found == root))
    return sorted(out, key=str)
