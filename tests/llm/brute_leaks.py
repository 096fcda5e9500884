"""Leaks by brute force: every stretch of every document against every item, by longest common subsequence."""

from shelfspark.llm import decontaminate as D


def words(text):
    return [w for w in (x.strip(D.SIGNS) for x in (text or "").lower().split()) if w]


def plain_lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        row, old = [0], row
        for j, y in enumerate(b, 1):
            row.append(old[j - 1] + 1 if x == y else max(old[j], row[-1]))
    return row[-1]


def leaks(docs, items, share=D.LCS_SHARE):
    """{(doc_id, item_id)} whose item stands in order in some stretch a third longer than it."""
    found = set()
    docs = [(d, words(body), set(words(body))) for d, body in docs]
    for i, text in items:
        item = words(text)
        for d, ws, known in docs:
            if item and sum(w in known for w in item) >= share * len(item):
                span = len(item) + len(item) // 3 + 1
                if any(plain_lcs(item, ws[a : a + span]) >= share * len(item) for a in range(0, max(1, len(ws) - span + 1), max(1, len(item) // 8))):
                    found.add((d, i))
    return found
