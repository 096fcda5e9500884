"""The batched trend fit against single fits, its backtest against plain loops, and the plan's reads."""

from __future__ import annotations

import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfspark.operators import forecast, stock, trend
from shelfspark.operators.sales import dense_monthly_series, monthly_sales


def months_of(start, count):
    return [f"{(start + i) // 12:04d}-{(start + i) % 12 + 1:02d}-01" for i in range(count)]


def single_fit(q, first, prior=trend.Prior()):
    """One series by least squares on stacked rows, the priors as further rows; scipy-free and unlike the normal equations."""
    n = len(q)
    early = 4 * n // 5
    count = min(25, early - 1)
    turns = [int(np.floor(j * (early - 1) / count + 0.5)) for j in range(1, count + 1)]
    row = lambda t: [1, t / (n - 1), *[max(0, (t - s) / (n - 1)) for s in turns], *[f(2 * np.pi * k * (t + first - 1) / 12) for k in range(1, 6) for f in (np.sin, np.cos)]]
    scales = [prior.trend, prior.trend, *[prior.change] * count, *[prior.wave] * 10]
    a = np.vstack([[row(t) for t in range(n)], np.diag([prior.noise / s for s in scales])])
    fitted = np.linalg.lstsq(a, np.concatenate([q, np.zeros(len(scales))]), rcond=None)[0]
    return max(0.0, float(np.dot(row(n), fitted)))


def items(seed=1):
    r = random.Random(seed)
    found = {}
    for item in range(40):
        n, start = r.choice([1, 3, 11, 12, 13, 20, 36, 60]), 2000 * 12 + r.randrange(12)
        slope = r.uniform(-1, 3)
        q = [max(0.0, round(20 + slope * i + (i > n / 2) * 10 + 5 * np.sin(i / 2) + r.gauss(0, 3))) if r.random() > 0.15 else 0.0 for i in range(n)]
        q[0], q[-1] = q[0] or 1.0, q[-1] or 2.0
        found[item] = (start, q)
    return found


@pytest.fixture(scope="module")
def sold(spark):
    rows = [(item, m, float(v)) for item, (start, q) in items().items() for m, v in zip(months_of(start, len(q)), q, strict=True) if v]
    return spark.createDataFrame(rows, "GoodsID long, m string, Qty double").select("GoodsID", F.to_date("m").alias("Month"), "Qty")


def test_fit_equals_single_fits(spark, sold):
    got = {r["GoodsID"]: r["Base"] for r in trend.forecast_trend(sold).collect()}
    want = {i: single_fit(q, start % 12 + 1) for i, (start, q) in items().items() if len(q) >= 12}
    assert got == {i: pytest.approx(v, abs=1e-6) for i, v in want.items()}
    # The same with the gaps written out, and for the items alone.
    again = {r["GoodsID"]: r["Base"] for r in trend.forecast_trend(dense_monthly_series(sold)).collect()}
    assert again == {i: pytest.approx(v, abs=1e-9) for i, v in got.items()}
    assert "BatchEvalPython" not in trend.forecast_trend(sold)._jdf.queryExecution().toString()


def test_backtest(spark, sold):
    got = {r["GoodsID"]: (r["folds"], r["mae_fit"], r["mae_mean"]) for r in trend.backtest(sold).collect()}
    want = {}
    for i, (start, q) in items().items():
        cuts = [m for m in range(len(q) - 3, len(q)) if m >= 12]
        if cuts:
            fit = [abs(single_fit(q[:m], start % 12 + 1) - q[m]) for m in cuts]
            mean = [abs(sum(q[m - 3 : m]) / 3 - q[m]) for m in cuts]
            want[i] = (len(cuts), pytest.approx(np.mean(fit), abs=1e-6), pytest.approx(np.mean(mean), abs=1e-9))
    assert got == want


def test_changepoints_follow_a_turn():
    """A series that turns after two thirds is forecast nearer to its new slope than a straight line would."""
    q = np.array([10.0 * i for i in range(40)] + [400 - 15.0 * i for i in range(20)])
    line = np.polyval(np.polyfit(range(60), q, 1), 60)
    assert abs(single_fit(q, 1, trend.Prior(noise=0.02)) - (400 - 15 * 20)) < abs(line - 100) / 5
    weights = trend.weights_of(60, [1], trend.Prior(noise=0.02))
    assert float(weights[0] @ q) == pytest.approx(single_fit(q, 1, trend.Prior(noise=0.02)))


def test_profile_rules_equal_the_single_operators(spark):
    r = random.Random(7)
    rows = [(i, f"2024-{r.randint(1, 12):02d}-{r.randint(1, 28):02d}", float(r.randint(-2, 30))) for i in range(30) for _ in range(r.choice([1, 2, 5, 40]))]
    daily = spark.createDataFrame(rows, "GoodsID long, d string, q double").groupBy("GoodsID", F.to_date("d").alias("rDate")).agg(F.sum("q").alias("TotalQty"))
    found = {r["GoodsID"]: r for r in forecast._profile_rules(forecast.demand_profile(daily)).collect()}
    series = dense_monthly_series(monthly_sales(daily))
    for name, df in (("rate", forecast.run_rate(daily)), ("mean3", forecast.trailing_mean(series)), ("peak", forecast.z_peak(series))):
        assert {i: x[name] for i, x in found.items()} == {r["GoodsID"]: pytest.approx(r["Base"]) for r in df.collect()}, name


def test_plan_reads_sales_once(spark, tmp_path):
    daily = spark.range(4000).select((F.col("id") % 50).alias("GoodsID"), F.date_add(F.lit("2022-01-01").cast("date"), (F.col("id") * 7 % 700).cast("int")).alias("rDate"), F.lit(2.0).alias("TotalQty"))
    goods = spark.range(50).select(F.col("id").alias("GoodsID"), F.concat(F.lit("P"), "id").alias("ProductCode"), F.lit("n").alias("Name"), F.lit(1.0).alias("CurrStock"), F.lit("c").alias("Category"), F.lit("3").alias("Note"))
    classes = spark.range(50).select(F.col("id").alias("GoodsID"), F.element_at(F.array(*map(F.lit, ("A", "B", "C", "New", "Excluded"))), (F.col("id") % 5 + 1).cast("int")).alias("ABC_Class"), F.element_at(F.array(*map(F.lit, ("X", "Y", "Z"))), (F.col("id") % 3 + 1).cast("int")).alias("XYZ_Class"), F.lit(0.5).alias("CV"), F.lit(4.0).alias("Mean_Monthly_Qty"), F.lit("s").alias("Strategy"))
    for name, df in (("daily", daily), ("goods", goods), ("classes", classes)):
        df.write.parquet(f"{tmp_path}/{name}")
    read = lambda n: spark.read.parquet(f"{tmp_path}/{n}")
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        plan = forecast.target_plan(read("classes"), stock.replenishment_view(read("goods")), read("daily"))
        assert plan.count() == 40
        text = plan._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
    assert text.count("TotalQty#") and text.count(f"{tmp_path}/daily") == 1
    assert "ReusedExchange" in text
    assert forecast.target_plan(read("classes"), stock.replenishment_view(read("goods")), read("daily"), sample=5).count() == 15
