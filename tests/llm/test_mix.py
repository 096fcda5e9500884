"""Mixing to target weights: targets against the rule, balance, bounds, equal reruns, probabilities."""

from __future__ import annotations

import random
from collections import defaultdict

import brute_mix
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfspark.llm import mixing

#: With columns whose names the operator uses itself.
SCHEMA = "doc_id long, source string, text string, size long, copy long, block long, p double, s string, n int, target int"


def make(spark, docs):
    return spark.createDataFrame([(*d, 1, 2, 3, 0.5, "s", 4, 5) for d in docs], SCHEMA)


def papers(n=900, seed=4):
    r = random.Random(seed)
    docs = []
    for i in range(n):
        source = "hot" if r.random() < 0.4 else r.choice(["a", "b", "é", "z", None, ""])
        docs.append((i, source, "w " * r.choice([0, 1, 3, 10, 40, 200, 3000 if i % 50 == 0 else 7])))
    docs += [(None, "hot", "a b"), (None, None, None), (5, "nothing", None), (6, "nothing", "")]
    return docs + [(7, "twins", "one two three")] * 200 + [(8, "one", "w " * 50)]


def test_mix(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(mixing, "BLOCK", 64)
    docs = papers()
    make(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    rows = mixing.op12_mixing(spark, str(tmp_path)).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0, r["size"]) for r in rows) == sorted((d is not None, d or 0, len((t or "").split())) for d, _, t in docs)
    sizes = defaultdict(int)
    for _, s, t in docs:
        sizes[s] += len((t or "").split())
    want = brute_mix.targets(sizes)
    assert sum(want.values()) == pytest.approx(sum(sizes.values()))
    found = mixing.mix(make(spark, docs)).collect()
    taken, wanted_docs, taken_docs = defaultdict(int), defaultdict(float), defaultdict(int)
    for r in found:
        assert r["source_size"] == sizes[r["source"]]
        assert r["target"] == pytest.approx(want[r["source"]])
        rate = r["target"] / r["source_size"] if r["source_size"] else 0.0
        assert int(rate + 1e-9) <= r["times"] <= min(3, -int(-rate - 1e-9) + 1)
        taken[r["source"]] += r["size"] * r["times"]
        taken_docs[r["source"]] += r["times"]
        wanted_docs[r["source"]] += rate
    for s in sizes:
        # Short documents land; of equal ones the last is drawn.
        room = 50 if s == "one" else 12
        assert abs(taken[s] - want[s]) <= room, s
        assert abs(taken_docs[s] - wanted_docs[s]) < 0.05 * len(docs), s
    again = mixing.mix(make(spark, docs[::-1]).repartition(9)).collect()
    key = lambda r: tuple((x is not None, x if x is not None else 0) for x in (r["source"] and r["source"].encode().hex(), r["doc_id"], r["size"], r["times"]))
    assert sorted(map(key, again)) == sorted(map(key, found))
    assert sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["taken"]) for r in rows) == sorted(((r["doc_id"] is not None, r["doc_id"] or 0), r["size"] * r["times"]) for r in found)


def test_empty(spark):
    assert mixing.mix(make(spark, [])).collect() == []
    assert [r["times"] for r in mixing.mix(make(spark, [(1, "a", None), (2, None, "")])).collect()] == [0, 0]


@settings(max_examples=6, deadline=None)
@given(st.dictionaries(st.one_of(st.none(), st.text("abé\U0001f600", max_size=3)), st.integers(0, 1000), min_size=1, max_size=12))
def test_targets_property(spark, sizes):
    rows = mixing.targets(spark.createDataFrame(list(sizes.items()), "source string, size long")).collect()
    want = brute_mix.targets(sizes)
    assert {r["source"]: pytest.approx(r["target"], abs=1e-6) for r in rows} == want


@given(st.lists(st.tuples(st.integers(0, 500), st.floats(0.001, 0.999)), max_size=60), st.integers(0, 99))
def test_flight_keeps_words(rows, seed):
    rows.sort(reverse=True)
    sizes, p = [r[0] for r in rows], [r[1] for r in rows]
    out = mixing.fly(sizes, p, random.Random(seed))
    assert sum(0 < x < 1 for x in out) <= 2
    assert sum(s * x for s, x in zip(sizes, out, strict=True)) == pytest.approx(sum(s * x for s, x in zip(sizes, p, strict=True)), abs=1e-3)
    landed = mixing.fly(sizes, p, random.Random(seed), land=True)
    assert all(x in (0, 1) for x in landed)


def test_flight_keeps_documents_too():
    """In a block of many lengths words and documents both stay, and what is left is short."""
    r = random.Random(3)
    sizes = sorted((int(r.lognormvariate(5, 1)) for _ in range(1500)), reverse=True)
    p = [0.37] * len(sizes)
    out = mixing.fly(sizes, p, random.Random(1))
    assert abs(sum(out) - sum(p)) < 20
    assert all(s < 100 for s, x in zip(sizes, out, strict=True) if 0 < x < 1)
    landed = mixing.fly(sizes, p, random.Random(1), land=True)
    assert abs(sum(s * x for s, x in zip(sizes, landed, strict=True)) - 0.37 * sum(sizes)) < 100


@pytest.mark.parametrize("land", [False, True])
def test_each_document_keeps_its_probability(land):
    """Over many draws each document is taken as often as it should be; only the shortest, which land, are off."""
    r = random.Random(1)
    sizes, p = sorted((r.randint(0, 50) for _ in range(30)), reverse=True), [r.uniform(0.1, 0.9) for _ in range(30)]
    total = [0.0] * 30
    for seed in range(2000):
        for i, x in enumerate(mixing.fly(sizes, p, random.Random(seed), land)):
            total[i] += x / 2000
    long = 15 if land else 30
    assert max(abs(a - b) for a, b in zip(total[:long], p[:long], strict=True)) < 0.05


def test_long_document_lands_where_others_make_up():
    """One document of more words than all others: either way the rest brings the words to the target."""
    sizes, p = [1000] + [10] * 80, [0.5] * 81
    for seed in range(20):
        out = mixing.fly(sizes, p, random.Random(seed), land=True)
        assert abs(sum(s * x for s, x in zip(sizes, out, strict=True)) - 900) <= 105
    sizes = [1000] + [10] * 150
    out = [mixing.fly(sizes, [0.5] * 151, random.Random(seed), land=True) for seed in range(20)]
    assert all(abs(sum(s * x for s, x in zip(sizes, o, strict=True)) - 1250) <= 10 for o in out)
    assert {o[0] for o in out} == {0.0, 1.0}
