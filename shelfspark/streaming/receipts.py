"""Supplier receipts as they come: files are parsed, resolved and filed batch by batch, each content once."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.receipts import clean_receipts, find_header, identify_supplier, receipt_rows, rejected_files, resolve_products, search_keywords
from ..sources.receipt_files import SCHEMA, sheet_of_text

LEDGER = "file string, md5 string, batch long"


def pending_files(spark: SparkSession, pending: str, processed: str) -> DataFrame:
    """A stream of (file, text) of new files; what is done moves to ``processed`` when a later batch has ended."""
    stream = spark.readStream.format("text").option("wholetext", True).option("cleanSource", "archive").option("sourceArchiveDir", processed)
    # Whole files are rows here; a receipt is a sheet of some thousand lines.
    files = stream.load(pending).select(F.col("_metadata.file_name").alias("file"), F.col("value").alias("text"))
    return files.where(~F.col("file").startswith("~$") & ~F.col("file").startswith("~%24"))


def lines_of(files: DataFrame) -> DataFrame:
    """file, line and cells of rows (file, text)."""

    def parse(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for name, text in zip(frame["file"], frame["text"], strict=True):
                rows = [(name, line, cells) for line, cells in sheet_of_text(text or "")]
                yield pd.DataFrame(rows, columns=["file", "line", "cells"])

    return files.select("file", "text").mapInPandas(parse, SCHEMA)


def _held(spark: SparkSession, path: str, schema: str) -> DataFrame:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    if not folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(path)


def receipts_batch(out: str, config: DataFrame, tables: Callable[[SparkSession], tuple[DataFrame, DataFrame]], in_date: str):
    """A foreachBatch writer: resolved lines, rejected files and the ledger of done files, each below ``out``.

    ``tables`` gives the mapping and the stock as they are now. A content that the ledger has, under whatever name, is not
    done again; of equal files in one batch the first by name is done. A batch's results are partitions of its number that
    are written over if it comes again, the ledger last, and its own ledger rows do not count, so a restart loses and
    doubles nothing.
    """

    def write(batch: DataFrame, number: int) -> None:
        spark = batch.sparkSession
        marked = batch.withColumn("md5", F.md5("text")).groupBy("md5").agg(F.min_by(F.struct("file", "text"), "file").alias("f")).select("f.file", "f.text", "md5")
        done = _held(spark, f"{out}/ledger", LEDGER).where(F.col("batch") != number).select("md5").distinct()
        new = marked.join(done, "md5", "left_anti").persist()
        try:
            if new.isEmpty():
                return
            mapping, stock = tables(spark)
            lines = lines_of(new).persist()
            headers = find_header(lines, search_keywords(config))
            found = identify_supplier(headers, config)
            resolved = resolve_products(clean_receipts(receipt_rows(lines, found), in_date), mapping, stock)
            put = lambda df, name: df.withColumn("batch", F.lit(number)).write.mode("overwrite").parquet(f"{out}/{name}/part={number}")
            put(resolved, "lines")
            put(rejected_files(lines, found), "rejected")
            put(new.select("file", "md5"), "ledger")
            lines.unpersist()
        finally:
            new.unpersist()

    return write


def receipts_stream(spark: SparkSession, pending: str, processed: str, out: str, config: DataFrame, tables, in_date: str, checkpoint: str):
    """The started query over all pending files; what is there is done, then it ends."""
    writer = pending_files(spark, pending, processed).writeStream.foreachBatch(receipts_batch(out, config, tables, in_date))
    return writer.option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
