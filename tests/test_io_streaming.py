"""Partitioned sync, CSV and receipt sources, and streams against their batch twins."""

from __future__ import annotations

import os

from pyspark.sql import functions as F

from shelfspark.plans.sync import high_watermark, sync_daily_sales
from shelfspark.sources import tables
from shelfspark.streaming import jobs


def sold(spark, rows):
    detail = spark.createDataFrame([(i, g, float(q), 1.5) for i, (g, _, q) in enumerate(rows)], "SalesMasterID long, GoodsID long, Quantity double, FinalAmt double")
    master = spark.createDataFrame([(i, d) for i, (_, d, _) in enumerate(rows)], "SID long, rDate int")
    return detail, master


def test_sync(spark, tmp_path):
    path = str(tmp_path / "sales")
    assert high_watermark(spark, path) is None
    first = [(1, 20240115, 2), (1, 20240115, 3), (2, 20240220, 1)]
    assert sync_daily_sales(spark, *sold(spark, first), path) == [("2024", "01"), ("2024", "02")]
    january = sorted(os.listdir(f"{path}/year=2024/month=01"))
    more = [*first, (2, 20240220, 4), (3, 20240301, 1)]
    assert sync_daily_sales(spark, *sold(spark, more), path) == [("2024", "02"), ("2024", "03")]
    got = {(r["GoodsID"], str(r["rDate"])): r["TotalQty"] for r in tables.read_daily_sales(spark, path).collect()}
    assert got == {(1, "2024-01-15"): 5.0, (2, "2024-02-20"): 5.0, (3, "2024-03-01"): 1.0}
    assert sorted(os.listdir(f"{path}/year=2024/month=01")) == january
    pruned = tables.read_daily_sales(spark, path, [("2024", "03")])
    assert pruned.count() == 1 and "PartitionFilters: [" in pruned._jdf.queryExecution().toString()


def test_csv_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("007", "五金")], "code string, name string")
    tables.write_csv_table(df, str(tmp_path / "t"))
    assert tables.read_csv_table(spark, str(tmp_path / "t"), "code string, name string").collect() == df.collect()


def test_stream_equals_batch_and_drops_late(spark, tmp_path):
    schema = "ts timestamp, GoodsID long, Quantity double, FinalAmt double"
    day = lambda d, h, g, q: (f"2024-01-{d:02d} {h:02d}:00:00", g, float(q), 2.0)
    batches = [[day(1, 1, 1, 1), day(1, 2, 1, 2)], [day(2, 1, 1, 4), day(1, 23, 2, 1)], [day(9, 1, 1, 1)], [day(1, 5, 1, 100)]]
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(source)
    stream = jobs.stream_daily_sales(spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(source))
    for i, rows in enumerate(batches):
        df = spark.createDataFrame(rows, "t string, GoodsID long, Quantity double, FinalAmt double")
        df.select(F.to_timestamp("t").alias("ts"), "GoodsID", "Quantity", "FinalAmt").coalesce(1).write.mode("append").parquet(source)
        query = stream.writeStream.outputMode("update").foreachBatch(jobs.upsert_sales_batch(out)).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    got = {(r["GoodsID"], str(r["rDate"])): r["TotalQty"] for r in tables.read_daily_sales(spark, out).collect()}
    assert got == {(1, "2024-01-01"): 3.0, (2, "2024-01-01"): 1.0, (1, "2024-01-02"): 4.0, (1, "2024-01-09"): 1.0}
