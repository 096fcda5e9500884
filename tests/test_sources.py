"""Receipt files, the batched sink, JDBC bounds, rebalanced months, and the stream of receipts."""

from __future__ import annotations

import glob
import json
import os
import shutil

import pytest
from pyspark.sql import functions as F

from shelfspark.sources import batched, receipt_files, tables
from shelfspark.streaming.receipts import receipts_stream


def cells(df):
    return sorted((r["file"], r["line"], r["cells"]) for r in df.collect())


def test_receipt_files(spark, tmp_path):
    wide = ",".join(f"c{i}" for i in range(200))
    files = {
        "a.csv": 'title\n\nCode,,Name,Qty\n0012,,"a, b\nsecond line",3\n,,\n7, ,x,"say ""hi"""\n',
        "wide.csv": wide + "\r\n" + ",".join(str(i) for i in range(200)) + "\r\n",
        "empty.csv": "",
        "blank.csv": "\n , ,\n",
        "~$a.csv": "x,y\n",
        "bom.csv": "﻿Code,Qty\n五金,1\n",
    }
    for name, text in files.items():
        (tmp_path / name).write_text(text, encoding="utf-8", newline="")
    (tmp_path / "sub").mkdir()
    (tmp_path / "sub" / "b.csv").write_text("one\n", encoding="utf-8")
    got = cells(receipt_files.read_receipt_lines(spark, str(tmp_path)))
    assert got == [
        ("a.csv", 0, ["title"]), ("a.csv", 2, ["Code", "Name", "Qty"]), ("a.csv", 3, ["0012", "a, b\nsecond line", "3"]), ("a.csv", 6, ["7", "x", 'say "hi"']),
        ("b.csv", 0, ["one"]), ("bom.csv", 0, ["Code", "Qty"]), ("bom.csv", 1, ["五金", "1"]),
        ("wide.csv", 0, [f"c{i}" for i in range(200)]), ("wide.csv", 1, [str(i) for i in range(200)]),
    ]


def test_small_files_share_a_partition(tmp_path, monkeypatch):
    monkeypatch.setattr(receipt_files, "PACK_FILES", 3)
    packs = receipt_files._packed([(1, f"f{i}", 10) for i in range(7)] + [(1, "big", 1 << 30), (1, "last", 1)])
    assert [p.paths for p in packs] == [["f0", "f1", "f2"], ["f3", "f4", "f5"], ["f6"], ["big"], ["last"]]
    assert receipt_files._packed([]) == []


def test_receipt_files_as_a_stream(spark, tmp_path):
    source, out = tmp_path / "in", str(tmp_path / "out")
    source.mkdir()
    stream = receipt_files.stream_receipt_lines(spark, str(source))

    def run():
        query = stream.writeStream.format("parquet").option("path", out).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        assert query.awaitTermination(90)
        return cells(spark.read.parquet(out))

    (source / "a.csv").write_text("x,1\n")
    assert run() == [("a.csv", 0, ["x", "1"])]
    (source / "b.csv").write_text("y,2\n")
    os.utime(source / "b.csv", ns=(2**62, 2**62))
    assert run() == [("a.csv", 0, ["x", "1"]), ("b.csv", 0, ["y", "2"])]
    assert run() == [("a.csv", 0, ["x", "1"]), ("b.csv", 0, ["y", "2"])]


def test_batched_sink(spark, tmp_path):
    store, ledger = str(tmp_path / "store"), str(tmp_path / "ledger")
    os.makedirs(store)
    open(f"{store}/fail", "w").close()
    rows = spark.range(95).select(F.concat(F.lit("P"), "id").alias("key"), F.lit(store).alias("store"), "id")
    send = lambda run: batched.send_batches(rows, "tests.sink_client:send", ledger, run, "key", size=10, parts=2)
    taken = lambda: [json.load(open(f)) for f in glob.glob(f"{store}/*.json")]
    with pytest.raises(Exception, match="store is away"):
        send("run-1")
    assert os.path.exists(f"{ledger}/run-1/aborted.json") and not os.path.exists(f"{ledger}/run-1/committed.json")
    first = len(taken())
    os.remove(f"{store}/fail")
    send("run-1")
    got = taken()
    # Nothing that the first try had sent and noted is sent again, and all rows arrive once.
    assert sorted(k for b in got for k in b) == sorted(f"P{i}" for i in range(95))
    assert all(len(b) <= 10 for b in got)
    end = json.load(open(f"{ledger}/run-1/committed.json"))
    assert end["rows"] == 95 and end["batches"] == len(got) and end["skipped"] == first
    assert not os.path.exists(f"{ledger}/run-1/aborted.json")
    send("run-1")
    assert len(taken()) == len(got)
    send("run-2")
    assert len(taken()) == 2 * len(got)


def test_jdbc_bounds(spark, tmp_path):
    url, driver = "jdbc:derby:memory:pos;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    rows = spark.range(1000).select(F.col("id").alias("SID"), F.date_add(F.lit("2024-01-01").cast("date"), (F.col("id") % 50).cast("int")).alias("sold"))
    rows.coalesce(1).write.format("jdbc").option("url", url).option("dbtable", "sales").options(**driver).mode("overwrite").save()
    query = 'SELECT "SID", "sold" FROM sales'
    plain = tables.read_jdbc(spark, url, query, **driver)
    assert plain.count() == 1000 and plain.rdd.getNumPartitions() == 1
    split = tables.read_jdbc(spark, url, query, '"SID"', 4, **driver)
    assert split.rdd.getNumPartitions() == 4 and split.count() == 1000
    sizes = split.groupBy(F.spark_partition_id()).count().collect()
    assert max(r["count"] for r in sizes) <= 260
    recent = tables.read_jdbc(spark, url, query, '"SID"', 4, since=900, **driver)
    assert recent.count() == 100 and recent.agg(F.min("SID")).first()[0] == 900
    days = tables.read_jdbc(spark, url, query, '"sold"', 4, since="2024-02-10", **driver)
    assert days.count() == 200 and days.rdd.getNumPartitions() == 4
    assert tables.read_jdbc(spark, url, query, '"SID"', 4, since=5000, **driver).count() == 0


def test_heavy_month_splits(spark, tmp_path):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    path = str(tmp_path / "sales")
    heavy = spark.range(400_000).select((F.col("id") % 5000).alias("GoodsID"), F.lit("2024-01-05").cast("date").alias("rDate"), F.rand(1).alias("TotalQty"), F.rand(2).alias("TotalAmt"), F.lit("2024").alias("year"), F.lit("01").alias("month"))
    light = heavy.limit(50).withColumns({"rDate": F.lit("2024-02-05").cast("date"), "month": F.lit("02")})
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1MB")
    try:
        tables.write_daily_sales(heavy.unionByName(light), path)
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    files = lambda month: glob.glob(f"{path}/year=2024/month={month}/*.parquet")
    assert len(files("01")) >= 3 and len(files("02")) == 1
    assert tables.read_daily_sales(spark, path).count() == 400_050
    january = sorted(files("01"))
    tables.write_daily_sales(light, path)
    assert sorted(files("01")) == january


def test_receipts_stream(spark, tmp_path):
    pending, done, out = (str(tmp_path / n) for n in ("pending", "done", "out"))
    os.makedirs(pending)
    config = spark.createDataFrame([(0, "S", "Code", "Price", "Qty", "Item", "No")], "ord int, supplier string, barcode_col string, price_col string, qty_col string, name_col string, markup_flag string")
    mapping = spark.createDataFrame([("X1", "bolt", "P9", 1)], "barcode string, item_name string, product_code string, ord int")
    stock = spark.createDataFrame([(1, "P1", "B1")], "GoodsID long, ProductCode string, Barcode string")
    sheet = 'Invoice\n\ncode,item,qty,price\nP1,"nut, small",2,3.5\nX1,bolt,1,1\nB1,tin,4,2\nZ,?,1,1\n'

    def run(files):
        for name, text in files.items():
            with open(f"{pending}/{name}", "w") as f:
                f.write(text)
        query = receipts_stream(spark, pending, done, out, config, lambda s: (mapping, stock), "20240105", str(tmp_path / "cp"))
        assert query.awaitTermination(120)
        return sorted((r["file"], r["barcode"], r["how"], r["product_code"]) for r in spark.read.parquet(f"{out}/lines").collect())

    first = [("a.csv", "B1", "barcode", None), ("a.csv", "P1", "code", "P1"), ("a.csv", "X1", "mapping", "P9"), ("a.csv", "Z", "unknown", None)]
    assert run({"a.csv": sheet, "~$a.csv": sheet}) == first
    # The same content again, under another name, and a file without a header.
    assert run({"again.csv": sheet, "odd.csv": "no,header\n1,2\n"}) == first
    assert [r["file"] for r in spark.read.parquet(f"{out}/rejected").collect()] == ["odd.csv"]
    assert run({"b.csv": sheet.replace("bolt,1", "bolt,7")}) == sorted(first + [("b.csv", *r[1:]) for r in first])
    # A batch that comes again, its results gone halfway, leaves the same result.
    last = max(glob.glob(f"{tmp_path}/cp/commits/[0-9]*"), key=lambda p: int(os.path.basename(p)))
    os.remove(last)
    for crc in glob.glob(f"{tmp_path}/cp/commits/.*crc"):
        os.remove(crc)
    shutil.rmtree(f"{out}/ledger/part={os.path.basename(last)}")
    assert run({}) == sorted(first + [("b.csv", *r[1:]) for r in first])
