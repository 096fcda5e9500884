"""A few registered queries against DuckDB; all of them are compared by the oracle run."""

from __future__ import annotations

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())


@pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not here")
@pytest.mark.parametrize("name", ["abc_classification", "xyz_stats", "min_multiple", "resolve_products", "z_peak", "last_purchase", "price_list_upsert", "mapping_verdicts"])
def test_oracle(spark, name):
    got = entry.queries()[name](spark, SF)
    con = duckdb.connect()
    for f in os.listdir(SF):
        con.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM '{SF}/{f}'")
    want = con.execute(entry.oracle_sql()[name])
    cols = [c[0] for c in want.description]
    assert sorted(cols) == sorted(got.columns)
    assert sorted(map(repr, (tuple(r) for r in got.select(*cols).collect()))) == sorted(map(repr, want.fetchall()))
