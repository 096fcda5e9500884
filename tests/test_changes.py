"""Bucketed state and targets, and the stream of changed rows: replays, changes, restarts."""

from __future__ import annotations

import hashlib
import os

import pytest
from pyspark.sql import functions as F

from shelfspark.sources import buckets as B
from shelfspark.streaming.changes import changed_stream, upsert_batch

SCHEMA = "key string, name string, stock double, note string"


def files(path):
    found = {}
    for folder, _, names in os.walk(path):
        for n in names:
            if n.endswith(".parquet"):
                with open(f"{folder}/{n}", "rb") as f:
                    found[f"{folder}/{n}"] = hashlib.sha256(f.read()).hexdigest()
    return found


def stock(spark, n, **more):
    df = spark.range(n).select(F.concat(F.lit("P"), "id").alias("key"), F.concat(F.lit("name "), "id").alias("name"), F.col("id").cast("double").alias("stock"))
    return df.withColumns(more)


def test_publish_touches_few_buckets(spark, tmp_path):
    target, state = str(tmp_path / "target"), str(tmp_path / "state")
    publish = lambda df: B.publish_changes(spark, df, "products", ["name", "stock"], target, state, SCHEMA)
    assert publish(stock(spark, 500)) == 500
    assert len([p for p in files(target) if "/bucket=" in p]) == B.BUCKETS
    B.upsert_buckets(spark, target, spark.createDataFrame([("P7", "kept")], "key string, note string"), SCHEMA)
    before, marks = files(target), files(state)
    assert publish(stock(spark, 500)) == 0
    assert files(target) == before and files(state) == marks
    change = F.when(F.col("key") == "P7", -1.0).otherwise(F.col("stock"))
    assert publish(stock(spark, 500).withColumn("stock", change)) == 1
    after = files(target)
    gone = set(before) - set(after)
    assert len(gone) == 1 and {os.path.dirname(p) for p in gone} == {os.path.dirname(p) for p in set(after) - set(before)}
    assert all(before[p] == after[p] for p in set(before) & set(after))
    row = B.read_buckets(spark, target, SCHEMA).where("key = 'P7'").first()
    assert (row["name"], row["stock"], row["note"]) == ("name 7", -1.0, "kept")
    assert B.read_buckets(spark, target, SCHEMA).count() == 500


def test_read_prunes_buckets(spark, tmp_path):
    path = str(tmp_path / "t")
    B.write_buckets(stock(spark, 300).withColumn("note", F.lit("n")), path)
    wanted = B.touched_buckets(spark.createDataFrame([("P1",), ("P2",)], "key string"))
    pruned = B.read_buckets(spark, path, SCHEMA, wanted)
    assert "PartitionFilters: [bucket" in pruned._jdf.queryExecution().toString()
    assert {"P1", "P2"} <= {r["key"] for r in pruned.collect()}
    assert pruned.select(F.input_file_name()).distinct().count() == len(wanted)
    assert B.read_buckets(spark, str(tmp_path / "none"), SCHEMA).count() == 0


@pytest.mark.parametrize("ttl", [None, "1 day"])
def test_stream_of_changes(spark, tmp_path, ttl):
    from datetime import timedelta

    source, target = str(tmp_path / "in"), str(tmp_path / "target")
    os.makedirs(source)
    sent = []

    def run(rows):
        """A new start of the stream from its checkpoint, after one more file."""
        spark.createDataFrame(rows, "key string, name string, stock double, at long").coalesce(1).write.mode("append").json(source)
        stream = spark.readStream.schema("key string, name string, stock double, at long").json(source)
        changed = changed_stream(stream, ["name", "stock"], "at", ttl=timedelta(days=1) if ttl else None)
        write = upsert_batch(target, SCHEMA, buckets=8)

        def both(batch, i):
            sent.extend((r["key"], r["stock"]) for r in batch.collect())
            write(batch, i)

        query = changed.writeStream.outputMode("update").foreachBatch(both).option("checkpointLocation", str(tmp_path / "cp")).trigger(**({"once": True} if ttl else {"availableNow": True})).start()
        assert query.awaitTermination(90)  # with a time to live, batches without data go on, so one is asked for
        out = sorted(sent)
        sent.clear()
        return out

    first = [("a", "x", 1.0, 1), ("b", "y", 2.0, 1), ("b", "y", 3.0, 2), (None, "z", 0.0, 1)]
    assert run(first) == [("a", 1.0), ("b", 3.0)]
    before = files(target)
    assert run([("a", "x", 1.0, 3), ("b", "y", 3.0, 4)]) == []
    assert files(target) == before
    assert run([("a", "x", 5.0, 5), ("c", "w", 1.0, 1)]) == [("a", 5.0), ("c", 1.0)]
    assert run(first) == [("a", 1.0)]
    got = {r["key"]: r["stock"] for r in B.read_buckets(spark, target, SCHEMA).collect()}
    assert got == {"a": 1.0, "b": 3.0, "c": 1.0}
