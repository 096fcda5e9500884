"""Calendar and weather features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.columns import holiday_category
from .windows import bfill, ffill, rolling_mean

NONE_NEAR = 999


def calendar_features(spark: SparkSession, holidays: DataFrame, start_year: int, end_year: int, new_year: str = "Lunar New Year") -> DataFrame:
    """A row per day with holiday flags and distances; worked out with a year more at each end, then cut."""
    span = spark.range(1).select(F.explode(F.expr(f"sequence(date'{start_year - 1}-01-01', date'{end_year + 1}-12-31', interval 1 day)")).alias("date"))
    named = holidays.groupBy("date").agg(F.min("holiday_name").alias("holiday_name"))
    days = span.join(F.broadcast(named), "date", "left")
    off = F.col("holiday_name").isNotNull()
    weekend = F.weekday("date") >= 5
    days = days.withColumns(
        {
            "day_of_week": F.weekday("date"),
            "is_weekend": weekend.cast("int"),
            "is_holiday": off.cast("int"),
            "holiday_category": holiday_category("holiday_name"),
            "is_working_day": (~weekend & ~off).cast("int"),
            "is_long_weekend": (off & F.weekday("date").isin(0, 4)).cast("int"),
            "__h": F.when(off, F.col("date")),
            "__n": F.when(F.lower("holiday_name").contains(new_year.lower()), F.col("date")),
        }
    )
    # The spine is one row a day: it is small, and its window may be one partition.
    ahead = Window.orderBy("date").rowsBetween(0, Window.unboundedFollowing)
    behind = Window.orderBy("date").rowsBetween(Window.unboundedPreceding, 0)
    near = lambda c, w, f: F.coalesce(F.abs(F.datediff(f(c, ignorenulls=True).over(w), "date")), F.lit(NONE_NEAR))
    days = days.withColumns(
        {
            "days_until_next_holiday": near("__h", ahead, F.first),
            "days_since_last_holiday": near("__h", behind, F.last),
            "days_until_cny": near("__n", ahead, F.first),
        }
    )
    return days.where(F.year("date").between(start_year, end_year)).drop("__h", "__n")


def weather_features(daily: DataFrame, first: str, last: str, station: str = "station") -> DataFrame:
    """date, mean_temp, temp_ma_7, temp_diff per station: filled forward, averaged, then cut and filled backward."""
    rows = daily.withColumn("mean_temp", ffill("mean_temp", "date", station))
    before = F.lag("mean_temp").over(Window.partitionBy(station).orderBy("date"))
    rows = rows.withColumns({"temp_ma_7": rolling_mean("mean_temp", 7, "date", station), "temp_diff": F.col("mean_temp") - before})
    rows = rows.where(F.col("date").between(F.lit(first).cast("date"), F.lit(last).cast("date")))
    return rows.select(station, "date", *[bfill(c, "date", station).alias(c) for c in ("mean_temp", "temp_ma_7", "temp_diff")])
