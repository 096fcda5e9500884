"""Daily sales as Structured Streaming queries."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.sales import merge_sales, with_month
from ..sources.tables import read_daily_sales, write_daily_sales


def stream_daily_sales(stream: DataFrame, key: str = "GoodsID", late: str = "1 day") -> DataFrame:
    """Sums per item and day of (ts, key, Quantity, FinalAmt); rows later than `late` behind the newest are dropped."""
    days = stream.withWatermark("ts", late).groupBy(F.window("ts", "1 day").alias("w"), F.col(key).alias("GoodsID"))
    sums = days.agg(F.sum("Quantity").alias("TotalQty"), F.sum(F.col("FinalAmt").cast("decimal(18,4)")).cast("double").alias("TotalAmt"))
    return with_month(sums.select("GoodsID", F.to_date("w.start").alias("rDate"), "TotalQty", "TotalAmt"))


def upsert_sales_batch(path: str):
    """A foreachBatch writer: totals of a batch replace those held; only touched months are written."""

    def write(batch: DataFrame, _: int) -> None:
        spark = batch.sparkSession
        batch.persist()
        months = [(r["year"], r["month"]) for r in batch.select("year", "month").distinct().collect()]
        if months:
            try:
                held = read_daily_sales(spark, path, months)
                merged = merge_sales(held, batch)
            except Exception as e:
                if "PATH_NOT_FOUND" not in str(e):
                    raise
                merged = batch
            write_daily_sales(merged, path)
        batch.unpersist()

    return write
