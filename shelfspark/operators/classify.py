"""Profit classes (ABC) and demand classes (XYZ)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import adjusted_cost, is_generic, strategy_label
from .sales import month_age, monthly_sales, recent_months, sales_summary
from .windows import prefix_sum

MONEY = "decimal(28,8)"


def fill_deleted(rows: DataFrame) -> DataFrame:
    """Zeros for missing numbers; items that left the master are named by their id."""
    gone = F.concat(F.lit("Deleted (ID: "), F.col("GoodsID").cast("string"), F.lit(")"))
    numbers = ["TotalQty", "TotalAmt", "CurrStock", "RetailPrice", "LastInCost", "AvgCost"]
    rows = rows.withColumns(
        {
            **{c: F.coalesce(c, F.lit(0.0)) for c in numbers},
            "SalesDays": F.coalesce("SalesDays", F.lit(0).cast("long")),
            "Name": F.when(F.col("ProductCode").isNull(), gone).otherwise(F.col("Name")),
            "Month_Age": F.greatest(F.coalesce("Month_Age", F.lit(99).cast("long")), F.lit(1).cast("long")),
        }
    )
    labels = ["Barcode", "Category", "Supplier", "Note", "InboundLocation"]
    return rows.withColumns({"ProductCode": F.coalesce("ProductCode", gone), **{c: F.coalesce(c, F.lit("DELETED")) for c in labels}})


def with_profit(stock: DataFrame, sales: DataFrame, ages: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Every item in stock or sold, with cost, profit and monthly profit."""
    rows = fill_deleted(stock.join(sales_summary(sales), "GoodsID", "full").join(ages, "GoodsID", "left"))
    rows = rows.withColumn("Is_Generic", is_generic("ProductCode", "Name"))
    rows = rows.withColumn("AdjustedCost", adjusted_cost("TotalAmt", "TotalQty", "LastInCost", ratio))
    rows = rows.withColumn("TotalCost", F.col("AdjustedCost") * F.col("TotalQty"))
    rows = rows.withColumn("TotalProfit", F.col("TotalAmt") - F.col("TotalCost"))
    return rows.withColumn("Monthly_Avg_Profit", F.col("TotalProfit") / F.col("Month_Age"))


def abc_classify(rows: DataFrame, new_below: int = 4, a: float = 0.7, b: float = 0.9) -> DataFrame:
    """Running share of the monthly profit of mature items, best first; the rest by rule."""
    ranked = (F.col("Is_Generic") == "No") & (F.col("Month_Age") >= new_below) & (F.col("Monthly_Avg_Profit") > 0)
    best = rows.where(ranked).select("GoodsID", "Monthly_Avg_Profit", F.col("Monthly_Avg_Profit").cast(MONEY).alias("__p"))
    running = prefix_sum(best, [F.col("Monthly_Avg_Profit").desc(), F.col("GoodsID").asc()], "__p", "__run")
    total = best.agg(F.sum("__p").alias("__total"))
    share = running.join(F.broadcast(total)).select("GoodsID", (F.col("__run").cast("double") / F.col("__total").cast("double")).alias("__share"))
    rows = rows.join(share, "GoodsID", "left")
    generic = F.col("Is_Generic") == "Yes"
    by_share = F.when(F.col("__share") <= a, "A").when(F.col("__share") <= b, "B").otherwise("C")
    abc = F.when(generic, "Excluded").when(F.col("Month_Age") < new_below, "New").when(F.col("__share").isNull(), "C").otherwise(by_share)
    ratio = F.when(generic, F.lit(None).cast("double")).otherwise(F.coalesce("__share", F.lit(1.0)))
    return rows.withColumns({"ProfitCumulativeRatio": ratio, "ABC_Class": abc}).drop("__share")


def xyz_stats(monthly: DataFrame) -> DataFrame:
    """Mean, deviation and class over all months in which anything was sold, months without sales as zero.

    From counts, sums and sums of squares; no item-by-month table is built.
    """
    months = monthly.agg(F.countDistinct("Month").cast("double").alias("__n"))
    sums = monthly.groupBy("GoodsID").agg(F.sum("Qty").alias("__s"), F.sum(F.col("Qty") * F.col("Qty")).alias("__ss"))
    rows = sums.join(F.broadcast(months)).withColumn("Mean_Monthly_Qty", F.col("__s") / F.col("__n"))
    var = F.when(F.col("__n") > 1, F.greatest(F.col("__ss") - F.col("__s") * F.col("__s") / F.col("__n"), F.lit(0.0)) / (F.col("__n") - 1))
    rows = rows.withColumn("Std_Monthly_Qty", F.sqrt(var))
    cv = F.when(F.col("Mean_Monthly_Qty") <= 0, 9.99).otherwise(F.col("Std_Monthly_Qty") / F.col("Mean_Monthly_Qty"))
    rows = rows.withColumn("CV", F.coalesce(cv, F.lit(9.99)))
    xyz = F.when(F.col("CV") <= 0.5, "X").when(F.col("CV") <= 1.0, "Y").otherwise("Z")
    return rows.withColumn("XYZ_Class", xyz).select("GoodsID", "Mean_Monthly_Qty", "Std_Monthly_Qty", "CV", "XYZ_Class")


def classify(stock: DataFrame, sales: DataFrame, ratio: float = 0.8) -> DataFrame:
    """Full classification: profit over the last 12 months, demand and age over all history."""
    rows = abc_classify(with_profit(stock, recent_months(sales), month_age(sales), ratio))
    stats = xyz_stats(monthly_sales(sales)).drop("Std_Monthly_Qty")
    rows = rows.join(stats, "GoodsID", "left").withColumns(
        {"CV": F.coalesce("CV", F.lit(9.99)), "XYZ_Class": F.coalesce("XYZ_Class", F.lit("Z"))}
    )
    return rows.withColumns(
        {"Strategy": strategy_label("ABC_Class", "XYZ_Class"), "displayname": F.concat("Name", F.lit(" | "), "ProductCode")}
    )


def class_rank() -> Column:
    return F.array_position(F.array(*map(F.lit, ("New", "A", "B", "C", "Excluded"))), F.col("ABC_Class"))


def class_order(rows: DataFrame) -> DataFrame:
    """New, A, B, C, Excluded; best profit first; for output only, since it sorts everything."""
    return rows.orderBy(class_rank(), F.col("Monthly_Avg_Profit").desc(), "GoodsID")


def class_counts(rows: DataFrame) -> DataFrame:
    return rows.groupBy("ABC_Class").agg(F.count("*").alias("n"))


def legacy_abc(stock: DataFrame, sales: DataFrame, new_first: bool = False) -> DataFrame:
    """Older variants: plain last cost, items in stock only; ranked by yearly profit, or by monthly profit without new items.

    Months_Active is days since the first sale by 30, 12 where nothing was sold, at least 1.
    """
    recent = recent_months(sales)
    last = sales.agg(F.max("rDate").alias("__last"))
    rows = stock.join(sales_summary(recent), "GoodsID", "left").join(F.broadcast(last))
    months = F.coalesce(F.datediff("__last", "FirstSaleDate") / 30.0, F.lit(12.0))
    rows = rows.withColumns({c: F.coalesce(c, F.lit(0.0)) for c in ("TotalQty", "TotalAmt", "LastInCost")})
    rows = rows.withColumn("Months_Active", F.greatest(months, F.lit(1.0)))
    rows = rows.withColumn("TotalProfit", F.col("TotalAmt") - F.col("TotalQty") * F.col("LastInCost"))
    value = F.col("TotalProfit") / F.col("Months_Active") if new_first else F.col("TotalProfit")
    rows = rows.withColumn("RankedProfit", value)
    ranked = F.col("RankedProfit") > 0
    if new_first:
        ranked = ranked & (F.col("Months_Active") >= 4)
    best = rows.where(ranked).select("GoodsID", "RankedProfit", F.col("RankedProfit").cast(MONEY).alias("__p"))
    running = prefix_sum(best, [F.col("RankedProfit").desc(), F.col("GoodsID").asc()], "__p", "__run")
    total = best.agg(F.sum("__p").alias("__total"))
    share = running.join(F.broadcast(total)).select("GoodsID", (F.col("__run").cast("double") / F.col("__total").cast("double")).alias("__share"))
    rows = rows.join(share, "GoodsID", "left")
    abc = F.when(F.col("__share") <= 0.7, "A").when(F.col("__share") <= 0.9, "B").otherwise("C")
    if new_first:
        abc = F.when(F.col("Months_Active") < 4, "New").otherwise(abc)
    return rows.select("GoodsID", "ProductCode", "Months_Active", "RankedProfit", abc.alias("ABC_Class"))
