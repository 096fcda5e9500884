"""Reading and writing tables: JDBC, partitioned sales, CSV, temperatures."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import schemas as S


def read_jdbc(spark: SparkSession, url: str, query: str, column: str | None = None, parts: int = 8, since=None, **options) -> DataFrame:
    """A query over JDBC. With a numeric or date column it is read in parallel, within bounds that one query tells.

    The store sends only the column's least and largest value for the bounds; where all rows have one value or none,
    one task reads. since, the last value held, keeps the rows from it on; the condition goes to the store.
    """
    reader = lambda: spark.read.format("jdbc").option("url", url).options(**options)
    if since is not None:
        text = f"'{since}'" if isinstance(since, (str, date)) else str(since)
        query = f"SELECT * FROM ({query}) held WHERE {column} >= {text}"
    if not column:
        return reader().option("query", query).load()
    low, high = reader().option("query", f"SELECT MIN({column}) AS low, MAX({column}) AS high FROM ({query}) bounds").load().first()
    if low is None or low == high:
        return reader().option("query", query).load()
    split = reader().option("dbtable", f"({query}) parts").option("partitionColumn", column)
    return split.option("lowerBound", str(low)).option("upperBound", str(high)).option("numPartitions", parts).load()


def read_daily_sales(spark: SparkSession, path: str, months: list[tuple[str, str]] | None = None) -> DataFrame:
    """Partitioned daily sales; with months, only those partitions are listed and read."""
    df = spark.read.schema(S.DAILY_SALES).parquet(path)
    if months is None:
        return df
    wanted = F.lit(False)
    for year, month in months:
        wanted = wanted | ((F.col("year") == year) & (F.col("month") == month))
    return df.where(wanted)


def write_daily_sales(df: DataFrame, path: str, most_rows: int = 5_000_000) -> None:
    """Replace only the months that df has.

    Rows are rebalanced by month: adaptive execution joins light months into a task and splits a heavy one over several
    by the advisory partition size, so no month waits for one task and light ones make few files. A file has at most
    most_rows rows.
    """
    rows = df.select("GoodsID", "rDate", "TotalQty", "TotalAmt", "year", "month").hint("rebalance", "year", "month")
    writer = rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "snappy")
    writer.option("maxRecordsPerFile", most_rows).partitionBy("year", "month").parquet(path)


def read_csv_table(spark: SparkSession, path: str, schema: str) -> DataFrame:
    return spark.read.csv(path, header=True, schema=schema, encoding="UTF-8")


def write_csv_table(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").csv(path, header=True, encoding="UTF-8")


def supplier_of_file(name: str = "file", marker: str = "_") -> Column:
    """The part of a file's name before a marker."""
    return F.substring_index(F.regexp_extract(F.col(name), r"([^/]+)$", 1), marker, 1)


def station_temperature(lines: DataFrame) -> DataFrame:
    """date and mean_temp from text rows (line, value): two lines of metadata, five columns, footer rows dropped."""
    cells = F.split("value", ",")
    part = lambda i: F.trim(F.get(cells, F.lit(i)))
    rows = lines.where(F.col("line") >= 2).select(
        part(0).try_cast("int").alias("y"),
        F.coalesce(part(1).try_cast("int"), F.lit(1)).alias("m"),
        F.coalesce(part(2).try_cast("int"), F.lit(1)).alias("d"),
        part(3).try_cast("double").alias("mean_temp"),
    )
    date = F.try_to_timestamp(F.format_string("%04d-%02d-%02d", "y", "m", "d"), F.lit("yyyy-MM-dd"))
    return rows.where("y is not null").select(F.to_date(date).alias("date"), "mean_temp").where("date is not null")


def read_station_temperature(spark: SparkSession, path: str) -> DataFrame:
    whole = spark.read.text(path, wholetext=True)
    return station_temperature(whole.select(F.posexplode(F.split("value", r"\r?\n")).alias("line", "value")))
