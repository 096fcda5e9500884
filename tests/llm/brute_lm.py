"""Exact counts, base scores and model scores by plain Python."""

import math
import re
import zlib
from collections import Counter

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def tokens(text):
    return [*re.findall("[^\x20\x09-\x0d]+", (text or "").translate(UPPER)), None]


def base(rows):
    """rows: (doc_id, text); {doc_id: (held_out, n_tokens, n_known, train_tokens, base_score)}."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    c = Counter(t for d, text in rows if not held[d] for t in tokens(text))
    n, v = sum(c.values()), len(c)
    return {
        d: (held[d], len(ts), sum(c[t] > 0 for t in ts), n, sum(math.log10((c[t] + 1) / (n + v + 1)) for t in ts))
        for d, text in rows
        for ts in [tokens(text)]
    }


def middle(c):
    """What is left of a count when only its power of two is kept: the middle of that range."""
    return 1.5 * 2 ** (c.bit_length() - 1) - 0.5 if c else 0.0


def scores(rows, mix):
    """{doc_id: log10 probability} by words, pairs and triples, without a filter's false hits."""
    held = {d: d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows}
    c = Counter()
    for d, text in rows:
        if not held[d]:
            ts = [None, None, *tokens(text)]
            for i in range(2, len(ts)):
                c.update([(ts[i],), (ts[i - 1], ts[i]), (ts[i - 2], ts[i - 1], ts[i])])
    n = sum(v for k, v in c.items() if len(k) == 1) + sum(len(k) == 1 for k in c) + 1
    out = {}
    for d, text in rows:
        ts, total = [None, *tokens(text)], 0.0
        for i in range(1, len(ts)):
            p = (middle(c[ts[i],]) + 1) / n
            for k in (1, 2):
                if i >= k and (h := middle(c[tuple(ts[i - k : i])])):
                    p = mix * min(middle(c[tuple(ts[i - k : i + 1])]) / h, 1.0) + (1 - mix) * p
            total += math.log10(p)
        out[d] = total
    return out
