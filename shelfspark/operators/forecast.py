"""Demand per item: season, run rates, recent peaks, a fitted month, and the target-stock plan."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import c_class_target, category_boost, final_demand, guard_base, target_stock
from .sales import dense_monthly_series, months_between
from .trend import LEAST, forecast_trend, trend_weights

PLAN = ("ProductCode", "Name", "ABC_XYZ", "Strategy", "CurrStock", "Base_Demand", "Final_Demand", "Target_Stock")


def seasonal_index(sales: DataFrame, stock: DataFrame) -> DataFrame:
    """Category, Month (1..12) and the mean ratio of that month's sales to the category's mean month.

    Only months in which the category sold count; a mean of zero counts as one.
    """
    named = sales.join(stock.select("GoodsID", "Category").where(F.col("Category").isNotNull()), "GoodsID")
    return _season(named.select("Category", F.trunc("rDate", "MM").alias("__m"), F.col("TotalQty").alias("__q")))


def _season(rows: DataFrame) -> DataFrame:
    months = rows.groupBy("Category", "__m").agg(F.sum("__q").alias("__q"))
    means = months.groupBy("Category").agg(F.avg("__q").alias("__mean"))
    mean = F.when(F.col("__mean") == 0, 1.0).otherwise(F.col("__mean"))
    ratios = months.join(means, "Category").select("Category", F.month("__m").alias("Month"), (F.col("__q") / mean).alias("__r"))
    return ratios.groupBy("Category", "Month").agg(F.avg("__r").alias("Seasonal_Index"))


def demand_profile(sales: DataFrame) -> DataFrame:
    """One row an item: months, its months with sales in order, as structs of Month, Qty, first and last day of sale.

    The array is as long as the history in months. Run rate, recent means, peaks, the fit's series and the categories'
    months all come from it, so daily sales are read and shuffled once.
    """
    # The same condition for all readers, so that they can share the exchange.
    months = sales.where("GoodsID is not null").groupBy("GoodsID", F.trunc("rDate", "MM").alias("Month")).agg(F.sum("TotalQty").alias("Qty"), F.min("rDate").alias("first"), F.max("rDate").alias("last"))
    return months.groupBy("GoodsID").agg(F.sort_array(F.collect_list(F.struct("Month", "Qty", "first", "last"))).alias("months"))


def _total(values) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, x: a + x)


def _profile_rules(rows: DataFrame) -> DataFrame:
    """rows of a profile with n, first and the demand by rule: rate, mean3 and peak; as run_rate, trailing_mean and z_peak."""
    begin, end = F.get("months", F.lit(0)), F.element_at("months", -1)
    total = _total(F.transform("months", lambda m: m["Qty"]))
    days = F.greatest(F.datediff(end["last"], begin["first"]), F.lit(1))
    rate = total / days * 30
    recent = lambda k: F.transform(F.filter("months", lambda m: months_between(m["Month"], end["Month"]) < k), lambda m: m["Qty"])
    rows = rows.withColumns({"n": months_between(begin["Month"], end["Month"]) + 1, "first": F.month(begin["Month"]), "__three": recent(3), "__six": recent(6)})
    gaps = F.array_repeat(F.lit(0.0), F.least(F.lit(6), F.col("n")) - F.size("__six"))
    top = F.array_max(F.transform("months", lambda m: m["Qty"]))
    rows = rows.withColumn("__six", F.sort_array(F.concat("__six", gaps), asc=False)).withColumn("__top", F.when(F.col("n") > F.size("months"), F.greatest(top, F.lit(0.0))).otherwise(top))
    one, two = F.get("__six", F.lit(0)), F.get("__six", F.lit(1))
    odd = (F.size("__six") >= 2) & (one == F.col("__top")) & (one > 0)
    return rows.withColumns(
        {
            "rate": F.when(days < 7, F.least(rate, total * 3)).otherwise(rate),
            "mean3": _total("__three") / F.least(F.lit(3), F.col("n")),
            "peak": F.when(odd, two).otherwise(one),
        }
    ).drop("__three", "__six", "__top")


def run_rate(sales: DataFrame) -> DataFrame:
    """New items: sales a day since the first sale, times 30; under a week at most three times what was sold."""
    t = sales.groupBy("GoodsID").agg(F.min("rDate").alias("__a"), F.max("rDate").alias("__b"), F.sum("TotalQty").alias("__q"))
    days = F.greatest(F.datediff("__b", "__a"), F.lit(1))
    rate = F.col("__q") / days * 30
    return t.select("GoodsID", F.when(days < 7, F.least(rate, F.col("__q") * 3)).otherwise(rate).alias("Base"))


def _recent(series: DataFrame, n: int) -> DataFrame:
    place = Window.partitionBy("GoodsID").orderBy(F.col("Month").desc())
    return series.withColumn("__n", F.row_number().over(place)).where(F.col("__n") <= n)


def trailing_mean(series: DataFrame, n: int = 3) -> DataFrame:
    return _recent(series, n).groupBy("GoodsID").agg(F.avg("Qty").alias("Base"))


def z_peak(series: DataFrame) -> DataFrame:
    """Highest of the last six months; the second highest where that is the highest of all history."""
    place = Window.partitionBy("GoodsID").orderBy(F.col("Month").desc())
    rows = series.withColumn("__n", F.row_number().over(place))
    t = rows.groupBy("GoodsID").agg(
        F.max("Qty").alias("__top"),
        F.sort_array(F.collect_list(F.when(F.col("__n") <= 6, F.col("Qty"))), asc=False).alias("__six"),
    )
    first, second = F.get("__six", F.lit(0)), F.get("__six", F.lit(1))
    odd = (F.size("__six") >= 2) & (first == F.col("__top")) & (first > 0)
    return t.select("GoodsID", F.when(odd, second).otherwise(first).alias("Base"))


def median_last(series: DataFrame, n: int = 6) -> DataFrame:
    return _recent(series, n).groupBy("GoodsID").agg(F.median("Qty").alias("Base"))


def last_weeks(sales: DataFrame, weeks: int = 4) -> DataFrame:
    """Sales within `weeks` weeks before an item's last sale, that day included."""
    last = sales.groupBy("GoodsID").agg(F.max("rDate").alias("__last"))
    rows = sales.join(last, "GoodsID").where(F.col("rDate") >= F.date_sub("__last", 7 * weeks))
    return rows.groupBy("GoodsID").agg(F.sum("TotalQty").alias("Base"))


def forecast_next_month(series: DataFrame, fn: Callable[[np.ndarray, int], float] | None = None, least: int = 12) -> DataFrame:
    """GoodsID, Base and failed for items with at least `least` months, gaps of zero counted.

    Without fn, all items are fitted at once: see ``trend``. fn, if given, takes a whole series and the calendar month of
    its start; where it raises or gives no number, Base is the series' mean and failed is 1.
    """
    if fn is None:
        return forecast_trend(series, least)
    packed = dense_monthly_series(series).groupBy("GoodsID").agg(F.sort_array(F.collect_list(F.struct("Month", "Qty"))).alias("__s"), F.count("*").alias("__n"))
    packed = packed.where(F.col("__n") >= least).select("GoodsID", F.month(F.col("__s")[0]["Month"]).alias("first"), F.col("__s.Qty").alias("q"))

    def fit(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            out, failed = [], []
            for first, q in zip(frame["first"], frame["q"], strict=True):
                try:
                    y = float(fn(np.asarray(q, float), int(first)))
                except Exception:
                    y = float("nan")
                failed.append(int(not np.isfinite(y)))
                out.append(float(np.mean(q)) if failed[-1] else max(0.0, y))
            yield pd.DataFrame({"GoodsID": frame["GoodsID"], "Base": out, "failed": failed})

    return packed.mapInPandas(fit, "GoodsID long, Base double, failed int")


def base_demand(labels: DataFrame, profile: DataFrame, model: bool = True) -> DataFrame:
    """labels with Base: run rate for new items, a fit or the last three months for X and Y, the recent peak for Z.

    Without model the last three months stand for the fit.
    """
    rows = _profile_rules(profile)
    steady = F.col("mean3")
    if model:
        pairs = rows.where(F.col("n") >= LEAST).select("n", "first").distinct()
        rows = rows.join(F.broadcast(trend_weights(pairs)), ["n", "first"], "left")  # bounded by the months of history: see trend
        begin = F.get("months", F.lit(0))["Month"]
        fit = _total(F.transform("months", lambda m: F.get("weights", months_between(begin, m["Month"])) * F.coalesce(m["Qty"], F.lit(0.0))))
        steady = F.when(F.col("weights").isNotNull(), F.greatest(fit, F.lit(0.0))).otherwise(steady)
    rows = labels.join(rows.select("GoodsID", "rate", "peak", steady.alias("steady")), "GoodsID", "left")
    base = F.when(F.col("ABC_Class") == "New", F.col("rate")).when(F.col("XYZ_Class").isin("X", "Y"), F.col("steady")).otherwise(F.col("peak"))
    return rows.withColumn("Base", F.coalesce(base, "Mean_Monthly_Qty", F.lit(0.0))).drop("rate", "peak", "steady")


def order_suggestion(plan: DataFrame, moq: float = 12.0) -> DataFrame:
    """Older order list: what is missing to the target, and the order under a minimum quantity."""
    from ..functions.columns import moq_order

    rows = plan.withColumn("Suggested_Order", F.greatest(F.col("Target_Stock") - F.col("CurrStock"), F.lit(0.0)))
    abc = F.regexp_replace("ABC_XYZ", "[XYZ]$", "")
    return rows.withColumn("Final_Order", moq_order("Suggested_Order", F.lit(moq), abc))


def plan_summary(plan: DataFrame) -> DataFrame:
    """Items, items to order, and the mean season boost of the items that have one (A, B and New)."""
    return plan.agg(
        F.count("*").alias("n_items"),
        F.coalesce(F.sum((F.col("Suggested_Order") > 0).cast("long")), F.lit(0).cast("long")).alias("n_to_order"),
        F.avg("Cat_Boost").alias("mean_boost"),
    )


def year_cap(target, year_qty, half: bool = True):
    """Older caps: half of a year's sales where the target passes them, or the year's sales at most."""
    capped = year_qty * 0.5 if half else year_qty
    return F.when((year_qty > 0) & (target > year_qty), capped).otherwise(target)


def target_plan(classes: DataFrame, replenishment: DataFrame, sales: DataFrame, model: bool = True, sample: int | None = None, boost: bool = False) -> DataFrame:
    """The plan for A, B and New items by strategy, and for C items by rule.

    classes: GoodsID, ABC_Class, XYZ_Class, CV, Mean_Monthly_Qty, Strategy. replenishment: today's stock with
    FirstOrderQty. sample: only so many A, B and New items, for trials. boost: with the column Cat_Boost.
    """
    keys = ["GoodsID", "ABC_Class", "XYZ_Class", "CV", "Mean_Monthly_Qty", "Strategy"]
    today = replenishment.select("GoodsID", "ProductCode", "Name", "CurrStock", "Category", F.col("FirstOrderQty").try_cast("double").alias("FirstOrderQty"))
    rows = classes.select(*keys).join(today, "GoodsID").where(F.col("ABC_Class").isin("A", "B", "New", "C"))
    by_rule = F.col("ABC_Class") == "C"
    if sample:
        rows = rows.where(~by_rule).orderBy("GoodsID").limit(sample).unionByName(rows.where(by_rule))
    profile = demand_profile(sales)
    next_month = profile.agg(F.month(F.add_months(F.max(F.element_at("months", -1)["last"]), 1)).alias("__next"))
    named = replenishment.select("GoodsID", "Category").where(F.col("Category").isNotNull())
    months = profile.join(named, "GoodsID").select("Category", F.explode("months").alias("m")).select("Category", F.col("m.Month").alias("__m"), F.col("m.Qty").alias("__q"))
    season = _season(months).join(F.broadcast(next_month), F.col("Month") == F.col("__next")).select("Category", "Seasonal_Index")
    rows = base_demand(rows, profile, model).join(season, "Category", "left")
    mean = F.coalesce("Mean_Monthly_Qty", F.lit(0.0))
    rows = rows.withColumn("Base", F.when(by_rule, mean).otherwise(guard_base("Base", "ABC_Class", "Mean_Monthly_Qty")))
    rows = rows.withColumn("Final", F.when(by_rule, mean).otherwise(final_demand("Base", "ABC_Class", "XYZ_Class", "Seasonal_Index")))
    target = target_stock("Final", "ABC_Class", "CV", "Mean_Monthly_Qty")
    rows = rows.withColumn("Target", F.when(by_rule, c_class_target("Mean_Monthly_Qty", "FirstOrderQty")).otherwise(target))
    cols = [
        "ProductCode",
        "Name",
        F.concat("ABC_Class", "XYZ_Class").alias("ABC_XYZ"),
        "Strategy",
        "CurrStock",
        *[F.bround(a, 2).alias(b) for a, b in (("Base", "Base_Demand"), ("Final", "Final_Demand"), ("Target", "Target_Stock"))],
    ]
    if boost:
        cols.append(F.when(~by_rule, F.round(category_boost("ABC_Class", "XYZ_Class", "Seasonal_Index"), 2)).alias("Cat_Boost"))
    return rows.select(*cols)
