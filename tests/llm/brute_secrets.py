"""A plain second version of the secret scan, for tests."""

import hashlib
import math
import re
from collections import Counter

from shelfspark.llm import secret_scan as S

ASSIGN = re.compile(r"""(?ai:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
PATTERNS = (("access", re.compile(r"AKIA[A-Z0-9]+"), 20), ("hex", re.compile(r"[0-9a-f]+"), 24))
ALLOWED = (
    r"[0-9A-Fa-f]{8}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{4}-[0-9A-Fa-f]{12}",
    r".*(?i:example|sample|dummy|placeholder).*",
    r"(?:[A-Za-z]+|[0-9]{1,4})(?:[+/_=-]+(?:[A-Za-z]+|[0-9]{1,4}))*[+/_=-]*",
)
ORDER = {"assign": 0, "access": 1, "hex": 2, "entropy": 3}


def base(text):
    out = [(m.start(), "assign", m.end()) for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    for kind, pattern, least in PATTERNS:
        out += [(m.start(), kind, m.end()) for m in pattern.finditer(text) if len(m[0]) >= least]
    return out


def entropy(text):
    out = []
    for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text):
        c = m[0]
        if not (re.search("[0-9]", c) and re.search("[A-Za-z]", c)) or any(re.fullmatch(p, c) for p in ALLOWED):
            continue
        least = S.HEX_BITS if re.fullmatch("[0-9A-Fa-f]+", c) else S.MIXED_BITS
        for i in range(len(c) - S.WINDOW + 1):
            counts = Counter(c[i : i + S.WINDOW]).values()
            if -sum(n / S.WINDOW * math.log2(n / S.WINDOW) for n in counts) >= least:
                a, b = m.start() + i, m.start() + i + S.WINDOW
                if out and out[-1][2] >= a and out[-1][0] >= m.start():
                    out[-1] = (out[-1][0], "entropy", b)
                else:
                    out.append((a, "entropy", b))
    return out


def joined(spans):
    return ",".join(f"{k}:{a}:{b}" for a, k, b in sorted(spans, key=lambda x: (x[0], ORDER[x[1]], x[2])))


def row(doc_id, text):
    text = text or ""
    b = base(text)
    n = Counter(k for _, k, _ in b)
    return (doc_id, n["assign"], n["access"], n["hex"], hashlib.sha256(joined(b).encode()).hexdigest(), joined(b + entropy(text)))
