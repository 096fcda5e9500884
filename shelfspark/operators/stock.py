"""Stock master and its views."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from ..functions.columns import clean_text, first_order_qty, note_description


def stock_master(goods: DataFrame, stock: DataFrame, dept: DataFrame, type1: DataFrame, type2: DataFrame, shop_id: int = 1) -> DataFrame:
    """Goods with the stock of one shop and the names of category, location and supplier, cleaned."""
    own = stock.where(F.col("ShopID") == shop_id).select(F.col("GoodsID").alias("SID"), "CurrStock")
    named = lambda d, key, name: d.select(F.col("SID").alias(key), F.col("Name").alias(name))
    rows = (
        goods.join(own, "SID", "left")
        .join(named(dept, "DeptID", "Category"), "DeptID", "left")
        .join(named(type1, "ProductType1ID", "InboundLocation"), "ProductType1ID", "left")
        .join(named(type2, "ProductType2ID", "Supplier"), "ProductType2ID", "left")
    )
    text = ["Barcode", "Name", "Note", "Category", "InboundLocation", "Supplier"]
    return rows.select(
        F.col("SID").alias("GoodsID"),
        clean_text("ID").alias("ProductCode"),
        *[clean_text(c).alias(c) for c in text[:3]],
        "CurrStock",
        "RetailPrice",
        "LastInCost",
        "AvgCost",
        *[clean_text(c).alias(c) for c in text[3:]],
    )


def supplier_dim(type2: DataFrame) -> DataFrame:
    return type2.select("SID", clean_text("Name").alias("Name")).orderBy("SID")


def replenishment_view(stock: DataFrame) -> DataFrame:
    return stock.withColumns({"FirstOrderQty": first_order_qty("Note"), "NoteDescription": note_description("Note")})


def product_columns(stock: DataFrame, columns=S.PRODUCT_COLUMNS) -> DataFrame:
    return stock.select(*[c for c in columns if c in stock.columns])


def inventory_health(stock: DataFrame, sales: DataFrame, days: int = 365, low_days: float = 14, dead_days: float = 365) -> DataFrame:
    """Average daily sales, days of inventory, and flags for low and dead stock."""
    last = sales.agg(F.date_sub(F.max("rDate"), days).alias("__from"))
    sold = sales.join(F.broadcast(last), F.col("rDate") > F.col("__from")).groupBy("GoodsID").agg(F.sum("TotalQty").alias("__q"))
    rows = stock.select("GoodsID", "ProductCode", "CurrStock").join(sold, "GoodsID", "left")
    daily = F.coalesce(F.col("__q"), F.lit(0.0)) / F.lit(float(days))
    rows = rows.withColumn("AvgDailySales", daily).drop("__q")
    cover = F.try_divide("CurrStock", "AvgDailySales")
    rows = rows.withColumn("DaysOfInventory", cover)
    return rows.withColumns(
        {
            "LowStock": F.when(F.coalesce(F.col("DaysOfInventory") < low_days, F.lit(False)), 1).otherwise(0),
            "DeadStock": F.when((F.col("CurrStock") > 0) & ((F.col("AvgDailySales") <= 0) | (F.col("DaysOfInventory") > dead_days)), 1).otherwise(0),
        }
    )
