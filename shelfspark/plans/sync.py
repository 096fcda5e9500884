"""Incremental sync of daily sales."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.sales import daily_sales, merge_sales
from ..sources.tables import read_daily_sales, write_daily_sales


def high_watermark(spark: SparkSession, path: str) -> date | None:
    """The last day held, from one column; null where nothing is held yet."""
    try:
        return read_daily_sales(spark, path).agg(F.max("rDate")).first()[0]
    except Exception as e:
        if "PATH_NOT_FOUND" in str(e):
            return None
        raise


def sync_daily_sales(spark: SparkSession, detail: DataFrame, master: DataFrame, path: str, default_start: str = "2024-01-01", overlap_days: int = 1) -> list[tuple[str, str]]:
    """Read the days from the last one held (less an overlap) again and replace the months that they touch.

    Whole days are aggregated anew, so a row that is replaced holds a full total. The list
    of touched months is a few literals, which prunes the partitions that are read.
    """
    last = high_watermark(spark, path)
    start = str(last - timedelta(days=overlap_days)) if last else default_start
    new = daily_sales(detail, master, start)
    months = sorted((r["year"], r["month"]) for r in new.select("year", "month").distinct().collect())
    if months:
        merged = new if last is None else merge_sales(read_daily_sales(spark, path, months), new)
        write_daily_sales(merged, path)
    return months
