"""The month after a monthly series: piecewise-linear trend with changepoints and yearly waves, fitted for all items at once.

The fit is least squares with normal priors on the coefficients, so a forecast is a weighted
sum of the series, and the weights depend on the series' length and first month of the year
only. They are solved once for each such pair (at most twelve a month of history), series of
equal length stacked in one batched solve; the items then need one sum of products, which
runs in the JVM. Months without sales add nothing to that sum, so no gaps are filled.

A series' length runs from its first to its last month. A null quantity counts as none.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .sales import months_between

#: Months that a series needs to be fitted.
LEAST = 12
#: Changepoints at most, evenly in the first four fifths of the history, and yearly waves.
CHANGES, WAVES = 25, 5


@dataclass(frozen=True)
class Prior:
    """Standard deviations, in units of the series: of a month's noise, of level and slope, of a change of slope, of a wave."""

    noise: float = 0.1
    trend: float = 5.0
    change: float = 0.05
    wave: float = 10.0

    def penalties(self, changes: int) -> list[float]:
        scales = [self.trend] * 2 + [self.change] * changes + [self.wave] * (2 * WAVES)
        return [self.noise**2 / s**2 for s in scales]


def changepoints(n: int) -> list[int]:
    """The months, from 0, after which the slope may change."""
    early = 4 * n // 5
    count = min(CHANGES, early - 1)
    return [int(j * (early - 1) / count + 0.5) for j in range(1, count + 1)]


def design(n: int, first: int) -> np.ndarray:
    """Level, slope, changes of slope and waves of months 0..n; n is the month to forecast, first the calendar month of month 0."""
    t = np.arange(n + 1)
    at = t / (n - 1)
    turns = [np.maximum(0.0, at - s / (n - 1)) for s in changepoints(n)]
    waves = [f(2 * np.pi * k * (t + first - 1) / 12) for k in range(1, WAVES + 1) for f in (np.sin, np.cos)]
    return np.column_stack([np.ones(n + 1), at, *turns, *waves])


def weights_of(n: int, firsts: list[int], prior: Prior = Prior()) -> np.ndarray:
    """One row of n weights for each first month: their products with a series sum up to its next month."""
    x = np.stack([design(n, first) for first in firsts])
    known, wanted = x[:, :n], x[:, n]
    square = known.transpose(0, 2, 1) @ known + np.diag(prior.penalties(x.shape[2] - 2 - 2 * WAVES))
    return (known @ np.linalg.solve(square, wanted[..., None]))[..., 0]


def trend_weights(lengths: DataFrame, prior: Prior = Prior()) -> DataFrame:
    """n, first and the array of weights of each distinct pair of length and first month."""

    def solve(pairs: pd.DataFrame) -> pd.DataFrame:
        firsts = sorted(pairs["first"].unique())
        found = weights_of(int(pairs["n"].iloc[0]), [int(f) for f in firsts], prior)
        return pd.DataFrame({"n": pairs["n"].iloc[0], "first": firsts, "weights": list(found)})

    return lengths.groupBy("n").applyInPandas(solve, "n int, first int, weights array<double>")


def _placed(series: DataFrame) -> DataFrame:
    """GoodsID, Qty, t (months since the item's first), n (months from first to last), first (calendar month of t = 0)."""
    item = Window.partitionBy("GoodsID")
    rows = series.select("GoodsID", "Month", F.coalesce("Qty", F.lit(0.0)).alias("Qty"), F.min("Month").over(item).alias("a"), F.max("Month").over(item).alias("b"))
    return rows.select("GoodsID", "Qty", months_between("a", "Month").alias("t"), (months_between("a", "b") + 1).alias("n"), F.month("a").alias("first"))


def _weighted(rows: DataFrame, prior: Prior) -> DataFrame:
    # At most twelve rows a month of history: a hundred years of months are 14,400 arrays, 70 MB.
    return rows.join(F.broadcast(trend_weights(rows.select("n", "first").distinct(), prior)), ["n", "first"])


def forecast_trend(series: DataFrame, least: int = LEAST, prior: Prior = Prior()) -> DataFrame:
    """GoodsID, Base (the next month, never below zero) and failed (1 where no number came out and the mean stands) of items with `least` months."""
    rows = _weighted(_placed(series).where(F.col("n") >= least), prior)
    sums = rows.groupBy("GoodsID", "n").agg(F.sum(F.get("weights", F.col("t")) * F.col("Qty")).alias("y"), F.sum("Qty").alias("q"))
    bad = F.col("y").isNull() | F.isnan("y") | (F.abs("y") == float("inf"))
    return sums.select("GoodsID", F.when(bad, F.col("q") / F.col("n")).otherwise(F.greatest("y", F.lit(0.0))).alias("Base"), bad.cast("int").alias("failed"))


def backtest(series: DataFrame, folds: int = 3, least: int = LEAST, prior: Prior = Prior()) -> DataFrame:
    """Rolling origins: GoodsID, folds, and the mean absolute error of the fit and of the mean of three months.

    The last months of each item, `folds` at most, are forecast one by one from the months before them, `least` at least.
    """
    rows = _placed(series).where(F.col("n") > least)
    origins = F.sequence(F.greatest(F.col("n") - folds, F.lit(least)), F.col("n") - 1)
    rows = rows.withColumn("n", F.explode(origins)).where(F.col("t") <= F.col("n"))
    before, close = F.col("t") < F.col("n"), F.col("t").between(F.col("n") - 3, F.col("n") - 1)
    tested = _weighted(rows, prior).groupBy("GoodsID", "n").agg(
        F.greatest(F.coalesce(F.sum(F.when(before, F.get("weights", F.col("t")) * F.col("Qty"))), F.lit(0.0)), F.lit(0.0)).alias("fit"),
        (F.coalesce(F.sum(F.when(close, F.col("Qty"))), F.lit(0.0)) / 3).alias("mean"),
        F.coalesce(F.sum(F.when(F.col("t") == F.col("n"), F.col("Qty"))), F.lit(0.0)).alias("real"),
    )
    error = lambda c: F.avg(F.abs(F.col(c) - F.col("real")))
    return tested.groupBy("GoodsID").agg(F.count("*").alias("folds"), error("fit").alias("mae_fit"), error("mean").alias("mae_mean"))
