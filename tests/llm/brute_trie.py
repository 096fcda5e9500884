"""A plain second version of the conversation trie, for tests."""

import hashlib
import re
import zlib
from collections import defaultdict


def nodes(rows, family=20):
    """rows: (conv_id, turn, role, text). Sorted tuples of the query's columns; without family nothing is grafted."""
    convs = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            role, text = role or "", text or ""
            digest = hashlib.md5(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()
            convs[c].append((turn is not None, turn or 0, digest, role, text))
    plain = {c: [(r, x) for _, _, _, r, x in sorted(turns)] for c, turns in convs.items()}
    built = {}
    for c, turns in plain.items():
        h = zlib.crc32(str(c).encode()) % 4 if family else 0
        base = c - int(c - family * int(c / family)) if family else c
        built[c] = plain.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in built.items():
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    kids, out = defaultdict(list), []
    for node in members:
        if node:
            kids[node[:-1]].append(node)
    leaves, saved = {}, {}
    for node in sorted(members, key=len, reverse=True):
        words = len(re.findall(r"[^\x20\x09-\x0D]+", node[-1][1])) if node else 0
        leaves[node] = sum(leaves[k] for k in kids[node]) if kids[node] else 1
        saved[node] = (len(members[node]) - 1) * words + sum(saved[k] for k in kids[node])
    for node, cs in members.items():
        ends = ",".join(str(c) for c in sorted(cs) if len(built[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        out.append((min(cs), len(node), parent, len(cs), len(kids[node]), leaves[node], saved[node], hashlib.sha256(ends.encode()).hexdigest()))
    return sorted(out, key=lambda r: (r[1], r[0]))
