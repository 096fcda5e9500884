"""Daily and monthly sales."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import yyyymmdd
from .windows import keep_last


def daily_sales(detail: DataFrame, master: DataFrame, since: str | None = None) -> DataFrame:
    """GoodsID, rDate, TotalQty, TotalAmt and the partition columns year and month."""
    heads = master.select(F.col("SID"), yyyymmdd("rDate").alias("rDate"))
    if since:
        heads = heads.where(F.col("rDate") >= F.lit(since).cast("date"))
    joined = detail.join(heads, detail["SalesMasterID"] == heads["SID"])
    amount = F.sum(F.col("FinalAmt").cast("decimal(18,4)")).cast("double")
    return with_month(joined.groupBy("GoodsID", "rDate").agg(F.sum("Quantity").alias("TotalQty"), amount.alias("TotalAmt")))


def with_month(sales: DataFrame) -> DataFrame:
    return sales.withColumns({"year": F.date_format("rDate", "yyyy"), "month": F.date_format("rDate", "MM")})


def merge_sales(old: DataFrame, new: DataFrame) -> DataFrame:
    """Old rows of the touched months and all new rows; for a key that both have, the new row."""
    months = new.select("year", "month").distinct()
    kept = old.join(F.broadcast(months), ["year", "month"], "left_semi")
    both = kept.withColumn("__new", F.lit(0)).unionByName(new.withColumn("__new", F.lit(1)))
    return keep_last(both, ["GoodsID", "rDate"], F.col("__new")).drop("__new")


def recent_months(sales: DataFrame, months: int = 12) -> DataFrame:
    """Rows from the day `months` calendar months before the last day on; that day counts."""
    last = sales.agg(F.add_months(F.max("rDate"), -months).alias("__from"))
    return sales.join(F.broadcast(last), F.col("rDate") >= F.col("__from")).drop("__from")


def sales_summary(sales: DataFrame) -> DataFrame:
    """Per item: quantity, amount, days with sales and first day. (GoodsID, rDate) is a key of daily sales."""
    return sales.groupBy("GoodsID").agg(
        F.sum("TotalQty").alias("TotalQty"),
        F.sum(F.col("TotalAmt").cast("decimal(18,4)")).cast("double").alias("TotalAmt"),
        F.count("rDate").alias("SalesDays"),
        F.min("rDate").alias("FirstSaleDate"),
    )


def months_between(first, last) -> Column:
    return (F.year(last) - F.year(first)) * 12 + F.month(last) - F.month(first)


def month_age(sales: DataFrame) -> DataFrame:
    """GoodsID and calendar months since its first sale, up to the last day of all sales, at least 1."""
    last = sales.agg(F.max("rDate").alias("__last"))
    firsts = sales.groupBy("GoodsID").agg(F.min("rDate").alias("__first")).join(F.broadcast(last))
    age = F.greatest(months_between(F.col("__first"), F.col("__last")), F.lit(1))
    return firsts.select("GoodsID", age.cast("long").alias("Month_Age"))


def monthly_sales(sales: DataFrame) -> DataFrame:
    return sales.groupBy("GoodsID", F.trunc("rDate", "MM").alias("Month")).agg(F.sum("TotalQty").alias("Qty"))


def dense_monthly_series(monthly: DataFrame) -> DataFrame:
    """Monthly sums with zeros in the gaps between an item's own first and last month."""
    spans = monthly.groupBy("GoodsID").agg(F.min("Month").alias("__a"), F.max("Month").alias("__b"))
    months = spans.select("GoodsID", F.explode(F.expr("sequence(__a, __b, interval 1 month)")).alias("Month"))
    return months.join(monthly, ["GoodsID", "Month"], "left").withColumn("Qty", F.coalesce("Qty", F.lit(0.0)))
