"""Edge rows and golden values of the retail operators."""

from __future__ import annotations

import math

import pytest
from pyspark.sql import functions as F

from shelfspark.functions import columns as C
from shelfspark.operators import classify, forecast, procurement, publish, receipts, sales, windows


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "x string").select(column("x")).first()[0]


@pytest.mark.parametrize("note,qty,text", [("12 24 36", "12", None), ("abc 12 def", "12", "abc def"), ("x12", None, "x12"), (None, None, None), ("７ box", "７", "box")])
def test_notes(spark, note, qty, text):
    assert one(spark, note, C.first_order_qty) == qty
    assert one(spark, note, C.note_description) == text


@pytest.mark.parametrize("text,want", [("-5", 5.0), ("$1,234.50", 1234.5), ("1.2.3", 0.0), ("", 0.0), (None, 0.0)])
def test_scrub(spark, text, want):
    assert one(spark, text, C.scrub_number) == want


@pytest.mark.parametrize("text,want", [("00123", "00123"), ("123.0", "123"), (" 123.000 ", "123"), ("1.05", "1.05")])
def test_codes(spark, text, want):
    assert one(spark, text, C.clean_code) == want


@pytest.mark.parametrize(
    "row,want", [((10.0, 0.0, 5.0), 5.0), ((90.0, 10.0, 1.0), 1.0), ((90.1, 10.0, 1.0), 7.208), ((50.0, 10.0, 0.0), 4.0), ((50.0, 10.0, None), 4.0), ((50.0, -1.0, -1.0), 0.0)]
)
def test_adjusted_cost(spark, row, want):
    df = spark.createDataFrame([row], "a double, q double, c double")
    assert df.select(C.adjusted_cost("a", "q", "c")).first()[0] == pytest.approx(want)


@pytest.mark.parametrize("row,want", [((None, 5.0), 0.0), ((0.0, 5.0), 0.0), ((2.0, None), 2.4), ((2.0, 0.0), 2.4), ((2.0, 24.0), 24.0), ((2.0, 25.0), 2.4)])
def test_c_class(spark, row, want):
    df = spark.createDataFrame([row], "m double, f double")
    assert df.select(C.c_class_target("m", "f")).first()[0] == pytest.approx(want)


def test_min_multiple_goldens(spark):
    cases = {"a": [24, 36, 12, 48], "b": [24, 24, 25, 36, 12], "c": [2, 3, 4], "d": [2, 24, 48, 24], "e": [7], " f ": [5]}
    rows = [(k, float(q)) for k, qs in cases.items() for q in qs]
    got = {r[0]: (r[1], r[2]) for r in procurement.min_multiple(spark.createDataFrame(rows, "GoodsNo string, ChQty double")).collect()}
    assert got == {"a": (12, 12), "b": (12, 12), "c": (2, 2), "d": (24, 24), "e": (7, 7), "f": (5, 5)}


def test_prefix_sum_equals_window(spark):
    df = spark.range(500).select("id", (F.col("id") % 7).alias("v"))
    got = windows.prefix_sum(df, [F.col("v").desc(), F.col("id").asc()], "v", "s", parts=4)
    want, total = {}, 0
    for i, v in sorted(((i, i % 7) for i in range(500)), key=lambda x: (-x[1], x[0])):
        total += v
        want[i] = total
    assert {r["id"]: r["s"] for r in got.collect()} == want


def test_prefix_sum_has_no_single_partition_sort(spark):
    df = spark.range(10).withColumn("v", F.lit(1))
    out = windows.prefix_sum(df, [F.col("id").asc()], "v", "s")
    plan = out._jdf.queryExecution().executedPlan().toString().lower()
    assert "windowspecdefinition(__range" in plan
    # Only the sums of the ranges, one row each, come together.
    assert plan.count("exchange singlepartition") == 1
    assert sorted((r["id"], r["s"]) for r in out.collect()) == [(i, i + 1) for i in range(10)]


def abc_rows(spark, profits):
    rows = [(i, p, "Yes" if g else "No", age) for i, (p, g, age) in enumerate(profits)]
    df = spark.createDataFrame(rows, "GoodsID long, Monthly_Avg_Profit double, Is_Generic string, Month_Age long")
    return {r["GoodsID"]: (r["ABC_Class"], r["ProfitCumulativeRatio"]) for r in classify.abc_classify(df).collect()}


def test_abc_rules(spark):
    got = abc_rows(spark, [(80.0, 0, 9), (12.0, 0, 9), (8.0, 0, 9), (-1.0, 0, 9), (50.0, 0, 3), (50.0, 1, 3), (0.0, 0, 4)])
    assert [got[i][0] for i in range(7)] == ["B", "C", "C", "C", "New", "Excluded", "C"]
    assert got[0][1] == pytest.approx(0.8) and got[3][1] == 1.0 and got[4][1] == 1.0 and got[5][1] is None


def test_xyz_single_month_and_constant(spark):
    rows = [(1, "2024-01-01", 5.0), (1, "2024-02-01", 5.0), (2, "2024-02-01", 4.0)]
    df = spark.createDataFrame(rows, "GoodsID long, Month string, Qty double")
    got = {r[0]: (r["CV"], r["XYZ_Class"]) for r in classify.xyz_stats(df).collect()}
    assert got[1] == (0.0, "X") and got[2][0] == pytest.approx(math.sqrt(2)) and got[2][1] == "Z"
    alone = classify.xyz_stats(df.where("GoodsID = 2")).first()
    assert (alone["CV"], alone["XYZ_Class"]) == (9.99, "Z")


def series(spark, values):
    rows = [(1, f"{2023 + i // 12}-{i % 12 + 1:02d}-01", float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "GoodsID long, m string, Qty double").select("GoodsID", F.to_date("m").alias("Month"), "Qty")


@pytest.mark.parametrize("values,want", [([1, 2, 9, 9], 9), ([1, 2, 9, 3], 3), ([50, 1, 1, 2, 1, 3, 1, 1], 3), ([4], 4), ([0, 0, 0], 0)])
def test_z_peak(spark, values, want):
    assert forecast.z_peak(series(spark, values)).first()["Base"] == want


def test_forecast_constant_and_season(spark):
    assert forecast.forecast_next_month(series(spark, [7] * 24)).first()["Base"] == pytest.approx(7, rel=0.01)
    wave = [10 + 5 * math.sin(2 * math.pi * (i + 1) / 12) for i in range(48)]
    got = forecast.forecast_next_month(series(spark, wave)).first()["Base"]
    assert got == pytest.approx(10 + 5 * math.sin(2 * math.pi * 49 / 12), abs=0.6)
    assert forecast.forecast_next_month(series(spark, [1] * 11)).count() == 0


def test_forecast_by_a_given_function(spark):
    """A function that fails, or gives no number, leaves the mean and is counted."""
    got = forecast.forecast_next_month(series(spark, [3] * 12), fn=lambda q, m: 1 / 0).first()
    assert (got["Base"], got["failed"]) == (3, 1)
    got = forecast.forecast_next_month(series(spark, [3] * 12), fn=lambda q, m: float(len(q) + m)).first()
    assert got["Base"] > 12 and got["failed"] == 0
    assert forecast.forecast_next_month(series(spark, [3] * 12), fn=lambda q, m: -4.0).first()["Base"] == 0


def test_merge_sales_is_idempotent(spark):
    old = sales.with_month(spark.createDataFrame([(1, "2024-01-01", 1.0, 1.0), (1, "2024-01-02", 1.0, 1.0), (1, "2023-12-31", 9.0, 9.0)], "GoodsID long, d string, TotalQty double, TotalAmt double").select("GoodsID", F.to_date("d").alias("rDate"), "TotalQty", "TotalAmt"))
    new = old.where("rDate = '2024-01-02'").withColumn("TotalQty", F.lit(5.0))
    once = sales.merge_sales(old, new)
    key = lambda d: sorted((str(r["rDate"]), r["TotalQty"]) for r in d.collect())
    assert key(once) == [("2024-01-01", 1.0), ("2024-01-02", 5.0)] == key(sales.merge_sales(once, new))


def test_changed_rows_and_upsert(spark):
    df = spark.createDataFrame([("a", 1.0, "x", 5.0), ("b", 2.0, None, 5.0)], "key string, q double, note string, AvgCost double")
    state = publish.fingerprints(df, "f", ["q", "note"])
    assert publish.changed_rows(df.withColumn("AvgCost", F.lit(9.0)), state, "f").count() == 0
    moved = df.withColumn("note", F.when(F.col("key") == "b", "y").otherwise(F.col("note")))
    assert [r["key"] for r in publish.changed_rows(moved, state, "f").collect()] == ["b"]
    assert publish.changed_rows(df, state, "other").count() == 2
    up = spark.createDataFrame([("a", None), ("c", "n")], "key string, note string")
    got = {r["key"]: (r["q"], r["note"]) for r in publish.merge_upsert(df.select("key", "q", "note"), up).collect()}
    assert got == {"a": (1.0, None), "b": (2.0, None), "c": (None, "n")}


def test_plan_upload(spark):
    df = spark.createDataFrame([(" a ", "2.5"), ("b", "x"), ("", "1"), ("c", "3.5")], "ProductCode string, Target_Stock string")
    got = [tuple(r) for r in publish.plan_upload_rows(df).collect()]
    assert got == [("a", 2), ("b", 0), ("c", 4)]


def test_header_rules(spark):
    kw = spark.createDataFrame([("code",), ("price",), ("qty",)], "keyword string")
    lines = [("a", i, [""]) for i in range(3)] + [("a", 5, ["Code", "Price"]), ("a", 6, ["qty", "PRICE"]), ("b", 1, ["code"])]
    lines += [("c", i, [f"x{i}"]) for i in range(20)] + [("c", 20, ["code", "qty"])]
    df = spark.createDataFrame(lines, "file string, line int, cells array<string>")
    found = receipts.find_header(df, kw)
    assert [(r["file"], r["line"], r["score"]) for r in found.collect()] == [("a", 5, 2)]
    assert sorted(r["file"] for r in receipts.rejected_files(df, found).collect()) == ["b", "c"]


def test_as_of(spark):
    facts = spark.createDataFrame([(1, 5), (1, 1), (2, 9)], "k int, t int")
    events = spark.createDataFrame([(1, 2, "a"), (1, 5, "b"), (2, 10, "c")], "k int, e int, v string")
    got = lambda f: {(r["k"], r["t"]): r["v"] for r in windows.as_of(facts, events, "k", "t", "e", ["v"], f).collect()}
    assert got(False) == {(1, 5): "b", (1, 1): None, (2, 9): None}
    assert got(True) == {(1, 5): "b", (1, 1): "a", (2, 9): "c"}
