"""The conversation trie against its brute-force version, and running values against plain ones."""

from __future__ import annotations

import random

import brute_trie
import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfspark.llm import prefix_trie, prefix_trie_sql
from shelfspark.llm.running import running

#: With columns whose names the operator uses itself.
SCHEMA = "conv_id long, turn long, role string, text string, b long, k long, t1 string, depth long, pos long, id string"


def talks(seed=5):
    r = random.Random(seed)
    rows = []
    for c in range(70):
        start = [f"hello {i}" for i in range(r.choice([0, 1, 2, 9, 17]))]
        turns = start + ["".join(r.choice("ab \n\t") for _ in range(r.randint(0, 5))) for _ in range(r.choice([0, 1, 2, 3, 8, 20]))]
        rows += [(c, i, "user" if i % 2 else None, t) for i, t in enumerate(turns)]
    rows += [(c, i, "user", "one and the same") for c in range(100, 130) for i in range(24)]
    rows += [(-7, 1, "user", "x"), (-20, 1, "user", "y z"), (None, 0, "user", "nobody"), (200, None, "user", None), (200, 0, None, "a"), (200, 0, None, "a")]
    rows += [(201, 3, "user", "tie"), (201, 3, "assistant", "tie"), (201, 3, "user", "a tie"), (202, 0, "user", "long " * 50_000)]
    return rows


def make(spark, rows):
    return spark.createDataFrame([(*row, 1, 2, "t", 3, 4, "i") for row in rows], SCHEMA)


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=lambda r: (r[1], r[0]))


def test_trie(spark, tmp_path):
    rows = talks()
    folder = str(tmp_path)
    make(spark, rows).write.parquet(f"{folder}/conversations.parquet")
    found = result(prefix_trie.op11_prefix_trie(spark, folder))
    assert found == brute_trie.nodes(rows)
    assert any(r[1] > 3 * prefix_trie.BLOCK for r in found)
    assert result(prefix_trie.trie(make(spark, rows))) == brute_trie.nodes(rows, family=None)
    conversations = make(spark, rows).toArrow()  # noqa: F841
    assert sorted(duckdb.sql(prefix_trie_sql.ORACLE_SQL).fetchall(), key=lambda r: (r[1], r[0])) == found


def test_empty(spark):
    assert result(prefix_trie.trie(make(spark, []), prefix_trie.FAMILY)) == []
    assert result(prefix_trie.trie(make(spark, [(None, 1, "user", "a")]))) == []


@settings(max_examples=3, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 30), st.one_of(st.none(), st.integers(0, 3)), st.sampled_from(["u", None]), st.sampled_from(["a", "a b", "", None])), min_size=1, max_size=60))
def test_trie_property(spark, rows):
    assert result(prefix_trie.trie(make(spark, rows), prefix_trie.FAMILY)) == brute_trie.nodes(rows)


def test_pieces_of_a_full_node(spark, monkeypatch):
    """Conversations that end in one node make many pieces, over more than one range; the digest is that of all."""
    monkeypatch.setattr(prefix_trie, "PIECE", 40)
    rows = [(c, 0, "user", "same") for c in range(3000)]
    assert result(prefix_trie.trie(make(spark, rows))) == brute_trie.nodes(rows, family=None)


@pytest.mark.parametrize("hot", [0.0, 0.5, 1.0])
def test_running(spark, hot):
    r = random.Random(2)
    rows = [("hot" if r.random() < hot else f"k{r.randrange(40)}", i, r.randrange(9), r.getrandbits(62)) for i in range(3000)]
    df = spark.createDataFrame(rows, "key string, i long, v long, x long")
    found = running(df.repartition(7), "key", [F.col("i")], ["v"], ["x"])
    sums, want = {}, {}
    for key, i, v, x in rows:
        a, b = sums.get(key, (0, 0))
        sums[key] = want[(key, i)] = (a + v, b ^ x)
    assert {(r["key"], r["i"]): (r["v_run"], r["x_run"]) for r in found.collect()} == want
    assert found.columns == ["key", "i", "v", "x", "v_run", "x_run"]
