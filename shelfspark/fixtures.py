"""Retail tables derived from the star-schema test tables, in Spark and as SQL for DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

AS_OF = "2001-11-04"

_GOODS_MAP = """SELECT p_partkey, CASE WHEN p_partkey%5 IN (0,1) THEN p_partkey%10
  WHEN p_partkey%5=2 THEN 1000+p_partkey%200 ELSE 10000+p_partkey END AS GoodsID FROM {part}"""

_LINES = """SELECT g.GoodsID, CAST(o_orderdate AS DATE) AS rDate, l_quantity,
  CAST(CAST(l_extendedprice AS DECIMAL(12,2))*(1-CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4)) AS amt, l_orderkey
  FROM {lineitem} JOIN {orders} ON l_orderkey=o_orderkey JOIN {goods_map} g ON g.p_partkey=l_partkey"""

_DAILY = """SELECT GoodsID, rDate, sum(l_quantity) AS TotalQty, CAST(sum(amt) AS DOUBLE) AS TotalAmt FROM {lines}
  WHERE NOT (GoodsID>=10000 AND GoodsID%10=3 AND rDate < DATE '2001-06-01') GROUP BY GoodsID, rDate"""

_STOCK = """SELECT m.GoodsID,
  CASE WHEN m.GoodsID=10008 THEN '202320232023' ELSE lpad(CAST(m.GoodsID AS STRING),8,'0') END AS ProductCode,
  concat('BC', lpad(CAST(m.GoodsID div 3 AS STRING),8,'0')) AS Barcode,
  CASE WHEN p.p_partkey%29=9 THEN concat('五金家品 ', p_name) ELSE p_name END AS Name,
  CASE p.p_partkey%4 WHEN 1 THEN concat(p_type,' ',CAST(p_size AS STRING))
    WHEN 2 THEN concat(CAST(p_size*10 AS STRING),' ',p_brand) WHEN 3 THEN concat(p_brand,chr(10),' see note ') END AS Note,
  CAST((p.p_partkey*7)%120 AS DOUBLE) AS CurrStock, p_retailprice AS RetailPrice,
  CASE WHEN p.p_partkey%10=8 THEN 0.0D WHEN p.p_partkey%17=5 THEN p_retailprice/10
    WHEN p.p_partkey%13=4 THEN p_retailprice*4 ELSE p_retailprice END AS LastInCost,
  p_retailprice*0.95D AS AvgCost, p_type AS Category, concat('LOC',CAST(p_size%7 AS STRING)) AS InboundLocation, p_brand AS Supplier
  FROM (SELECT GoodsID, min(p_partkey) AS p_partkey FROM {goods_map} GROUP BY GoodsID) m JOIN {part} p ON m.p_partkey=p.p_partkey
  WHERE m.GoodsID%50 <> 49"""

_INBOUND = """SELECT lpad(CAST(l_partkey AS STRING),8,'0') AS GoodsNo,
  CASE WHEN l_linenumber=1 THEN l_quantity ELSE CAST((1+l_partkey%4)*6*(1+CAST(l_quantity AS BIGINT)%3) AS DOUBLE) END AS ChQty,
  CAST(date_format(l_shipdate,'yyyyMMdd') AS INT) AS BillDate, CASE l_returnflag WHEN 'R' THEN 2 ELSE 1 END AS MoveTypeID FROM {lineitem}"""

_RECEIPTS = """SELECT concat('file', l_suppkey%7, '-', date_format(l_shipdate,'yyyyMMdd')) AS file, l_orderkey*10+l_linenumber AS line,
  CASE l_partkey%4 WHEN 0 THEN s.ProductCode WHEN 1 THEN concat(coalesce(s.ProductCode,''),'.0') WHEN 2 THEN s.Barcode ELSE concat('X',CAST(l_partkey AS STRING)) END AS barcode,
  concat('$ ', CAST(CAST(l_extendedprice AS DECIMAL(12,2)) AS STRING)) AS unit_cost,
  concat(CAST(CAST(l_quantity AS BIGINT) AS STRING), ' pcs') AS qty, p_name AS item_name,
  concat('S', CAST(l_suppkey%7 AS STRING)) AS supplier, CASE WHEN l_suppkey%7=0 THEN 'Yes' ELSE 'No' END AS markup_flag, l_partkey
  FROM {lineitem} JOIN {part} p ON p.p_partkey=l_partkey JOIN {goods_map} g ON g.p_partkey=l_partkey LEFT JOIN {stock} s ON s.GoodsID=g.GoodsID"""

_MAPPING = """SELECT barcode, item_name, min(product_code) AS product_code, 'old' AS supplier, min(l_partkey) AS ord FROM (
  SELECT concat('X',CAST(g.p_partkey AS STRING)) AS barcode, p_name AS item_name, lpad(CAST(g.GoodsID AS STRING),8,'0') AS product_code, g.p_partkey AS l_partkey
  FROM {part} p JOIN {goods_map} g ON g.p_partkey=p.p_partkey WHERE g.p_partkey%8=3 AND g.GoodsID%50<>49) GROUP BY barcode, item_name"""

#: Days with names, for the calendar.
HOLIDAYS = [
    ("2022-02-01", "Lunar New Year"), ("2022-04-05", "Qingming Festival"), ("2022-10-01", "National Day"), ("2022-12-26", "Christmas Day observed"),
    ("2023-01-01", "New Year's Day"), ("2023-01-22", "Lunar New Year"), ("2023-04-07", "Good Friday"), ("2023-05-01", "Labour Day"),
    ("2023-10-02", "National Day observed"), ("2023-12-25", "Christmas Day"), ("2024-01-01", "New Year's Day"), ("2024-02-10", "Lunar New Year"),
    ("2024-04-01", "Easter Monday"), ("2024-05-01", "Labour Day"), ("2024-06-10", "Dragon Boat Festival"), ("2024-12-25", "Christmas Day"),
    ("2025-01-01", "New Year's Day"), ("2025-01-29", "Lunar New Year"), ("2025-05-01", "Labour Day"), ("2026-02-17", "Lunar New Year"),
]


def tables(spark: SparkSession, sf: str) -> dict[str, DataFrame]:
    """The derived tables, lazily: nothing is read before an action."""
    read = lambda n: spark.read.parquet(f"{sf}/{n}.parquet")
    t = {n: read(n) for n in ("part", "orders", "lineitem", "events", "customer", "nation")}
    t["goods_map"] = spark.sql(_GOODS_MAP, part=t["part"])
    t["lines"] = spark.sql(_LINES, **{k: t[k] for k in ("lineitem", "orders", "goods_map")})
    t["daily"] = spark.sql(_DAILY, lines=t["lines"])
    t["stock"] = spark.sql(_STOCK, goods_map=t["goods_map"], part=t["part"])
    t["inbound"] = spark.sql(_INBOUND, lineitem=t["lineitem"])
    t["receipts"] = spark.sql(_RECEIPTS, **{k: t[k] for k in ("lineitem", "part", "goods_map", "stock")})
    t["mapping"] = spark.sql(_MAPPING, part=t["part"], goods_map=t["goods_map"])
    t["holidays"] = spark.createDataFrame(HOLIDAYS, "d string, holiday_name string").select(F.to_date("d").alias("date"), "holiday_name")
    return t


def _duck(sql: str, **names: str) -> str:
    """The same text in DuckDB's dialect, over CTE names."""
    names = {n: n for n in ("part", "orders", "lineitem", "goods_map", "lines", "stock")} | names
    sql = sql.format(**names).replace(" div ", "//").replace("AS STRING", "AS VARCHAR").replace("0.0D", "0.0e0").replace("0.95D", "0.95e0")
    return sql.replace("date_format(l_shipdate,'yyyyMMdd')", "strftime(l_shipdate,'%Y%m%d')")


_HOLIDAY_ROWS = ", ".join("(DATE '{}', '{}')".format(d, n.replace("'", "''")) for d, n in HOLIDAYS)

CTES = ",\n".join(
    f"{name} AS ({_duck(sql)})"
    for name, sql in (
        ("goods_map", _GOODS_MAP), ("lines", _LINES), ("daily", _DAILY), ("stock", _STOCK), ("inbound", _INBOUND), ("receipts", _RECEIPTS), ("mapping", _MAPPING),
    )
) + f",\nholidays(date, holiday_name) AS (VALUES {_HOLIDAY_ROWS})"


def with_tables(sql: str, more: str = "") -> str:
    """sql over the derived tables; more: further CTEs."""
    return f"WITH {CTES}{',' if more else ''}\n{more}\n{sql}"
