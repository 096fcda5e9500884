"""The Merkle manifest against its brute-force version and its SQL."""

from __future__ import annotations

import random

import brute_merkle
import duckdb
import pytest

from shelfspark.llm import merkle, merkle_sql

#: With columns whose names the operator uses itself.
SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, key string, pos long, block long, hash string, n int"


def make(spark, docs):
    return spark.createDataFrame([(*d, "k", 1, 2, "h", 3) for d in docs], SCHEMA)


def papers(n, sources=4, seed=1):
    r = random.Random(seed)
    docs = []
    for i in range(n):
        source = "hot" if r.random() < 0.4 else r.choice([f"s{k}" for k in range(sources)])
        docs.append((i, source, r.choice(["en", None]), r.choice([5, None]), r.choice(["Text", "text", "ÉTÉ 2", "", None]) and f"T{r.random()}"))
    docs += [(None, None, None, None, None), (None, "hot", "en", 1, "A"), (3, "hot", "en", 2, "Twice"), (3, "hot", "en", 2, "Twice"), (3, "hot", "en", 2, "other")]
    return docs + [(2**60 + 5, "hot", "en", 9, "Big id"), (9_000, "lone", "en", 1, "Alone"), (9_001, "", "en", 1, "empty name"), (9_002, "é", "fr", 300_000, "Lo ng" * 60_000)]


def result(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_merkle(spark, tmp_path):
    docs = papers(600)
    make(spark, docs).write.parquet(f"{tmp_path}/documents.parquet")
    found = result(merkle.op13_merkle(spark, str(tmp_path)))
    assert found == brute_merkle.rows(docs)
    assert {r[-1] for r in found} == {True, False}
    documents = make(spark, docs).toArrow()  # noqa: F841
    assert sorted(duckdb.sql(merkle_sql.ORACLE_SQL).fetchall(), key=str) == found


def test_rounds(spark):
    """A source of more than one superblock, its last of one leaf, and more sources than one run."""
    docs = [(i, "big", "en", 1, f"T{i}") for i in range(merkle.SUPER * 2 + 1)] + [(i, f"s{i % 40}", "en", 1, f"T{i}") for i in range(200)]
    from pyspark.sql import functions as F

    found = merkle.manifest(make(spark, docs), F.crc32(F.col("doc_id").cast("string").cast("binary")) % 5 == 0)
    assert result(found) == brute_merkle.rows(docs)


@pytest.mark.parametrize("docs", [[], [(1, None, None, None, None)], [(1, "a", "en", 1, "x")] * 20])
def test_small(spark, docs):
    found = result(merkle.manifest(make(spark, docs)))
    want = brute_merkle.rows(docs)
    assert [r[:5] for r in found] == [r[:5] for r in want]
    assert all(r[-1] for r in found)
