"""Fills and as-of look-ups where one key holds half of all rows; orders with equal rows; supplier look-up at size."""

from __future__ import annotations

import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from shelfspark.operators import publish, receipts, windows


def rows_of(spark, n=6000):
    r = random.Random(3)
    rows = [("hot" if r.random() < 0.5 else r.choice(["a", "b", "c", None]), i, float(i) if r.random() < 0.02 else None) for i in range(n)]
    return spark.createDataFrame(rows, "k string, t long, v double")


@pytest.mark.parametrize("forward", [False, True])
def test_fill_spread(spark, forward):
    df = rows_of(spark)
    w = Window.partitionBy("k").orderBy("t")
    plain = F.first("v", True).over(w.rowsBetween(0, Window.unboundedFollowing)) if forward else F.last("v", True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    key = lambda r: (r["k"] or "", r["t"])
    want = sorted(df.withColumn("f", plain).collect(), key=key)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = sorted(windows.fill_spread(df, "k", ["t"], "v", "f", forward).collect(), key=key)
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert got == want


def test_fill_spread_has_even_tasks(spark):
    dealt = rows_of(spark).repartitionByRange(4, "k", "t").groupBy(F.spark_partition_id().alias("p")).count()
    sizes = [r["count"] for r in dealt.collect()]
    assert len(sizes) == 4 and max(sizes) < 2 * min(sizes)


@pytest.mark.parametrize("forward", [False, True])
def test_as_of_spread(spark, forward):
    r = random.Random(5)
    facts = spark.createDataFrame([(i, "hot" if i % 2 else r.choice("abc"), r.randrange(5000)) for i in range(3000)], "i long, k string, t long")
    events = spark.createDataFrame([("hot" if i % 2 else r.choice("abd"), t, i) for i, t in enumerate(r.sample(range(5000), 80))], "k string, at long, paid long")
    run = lambda spread: sorted(tuple(x) for x in windows.as_of(facts, events, "k", "t", "at", ["paid"], forward, spread).select("i", "at", "paid").fillna(-1).collect())
    assert run(True) == run(False)


def test_ranked_rows_keeps_equal_rows(spark):
    rows = [("b", 1, 2.0)] * 150 + [("a", 5, 1.0), ("b", 1, 1.0), ("b", None, 7.0), ("a", 5, 1.0)]
    got = sorted(tuple(r) for r in publish.ranked_rows(spark.createDataFrame(rows, "g string, d int, q double"), ["g", "d"]).select("place", "g", "d", "q").collect())
    want = sorted(rows, key=lambda r: (r[0], r[1] is not None, r[1] or 0, r[2]))
    assert got == [(i, *r) for i, r in enumerate(want, 1)]


def test_fan_out_classification(spark):
    products = spark.createDataFrame([("a", "n1", "Z"), ("b", "n2", "Z")], "key string, name string, ABC_Class string")
    replenishment = spark.createDataFrame([("b", 5)], "key string, qty int")
    feed = spark.createDataFrame([("b", "A", "X", None, "m"), ("c", "New", "Z", "note", "m")], "key string, ABC_Class string, XYZ_Class string, note string, md5 string")
    one, two = publish.fan_out_classification(products, replenishment, feed)
    assert sorted(map(tuple, one.select("key", "name", "ABC_Class", "note").collect())) == [("a", "n1", "Z", None), ("b", "n2", "A", None), ("c", None, "New", "note")]
    assert sorted(map(tuple, two.select("key", "qty", "ABC_Class", "XYZ_Class").collect())) == [("b", 5, "A", "X"), ("c", None, "New", "Z")]


def test_many_supplier_configurations(spark):
    """100,000 configurations that share three of their names; the first in order wins."""
    n = 100_000
    config = spark.range(n).select(
        F.col("id").cast("int").alias("ord"), F.concat(F.lit("S"), "id").alias("supplier"), F.concat(F.lit("Code "), F.col("id") % (n // 2)).alias("barcode_col"),
        F.lit("Price").alias("price_col"), F.lit("Qty").alias("qty_col"), F.concat(F.lit("Item"), F.col("id") % 10).alias("name_col"), F.lit("No").alias("markup_flag"),
    )
    headers = spark.range(200).select(
        F.concat(F.lit("f"), "id").alias("file"), F.lit(3).alias("line"),
        F.array(F.concat(F.lit(" code "), F.col("id") * 7), F.lit("PRICE"), F.lit("qty "), F.concat(F.lit("item"), (F.col("id") * 7 + F.when(F.col("id") % 5 == 0, 1).otherwise(0)) % 10), F.lit("")).alias("cells"),
    )
    found = receipts.identify_supplier(headers, config)
    got = {r["file"]: r["ord"] for r in found.select("file", "ord").collect()}
    assert got == {f"f{i}": i * 7 for i in range(200) if i % 5}
    assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
