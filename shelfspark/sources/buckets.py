"""Keyed tables in hash buckets: fingerprints and targets of which a run touches a few rows.

A table is a folder of Parquet partitions ``bucket=n`` by a hash of the key. An upsert finds
the buckets of its keys, reads those alone, and overwrites those alone; all other files keep
their bytes. Cost follows the touched buckets and not the table.

The number of buckets is stated in the folder's name of the first write and must not change;
with 4096 buckets a table of 1 TB has 250 MB a bucket.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.publish import changed_rows, merge_upsert

BUCKETS = 64


def bucket_of(key: str, buckets: int = BUCKETS) -> Column:
    return F.pmod(F.xxhash64(F.col(key).cast("string")), F.lit(buckets)).cast("int")


def touched_buckets(df: DataFrame, key: str = "key", buckets: int = BUCKETS) -> list[int]:
    """The buckets that df's keys fall into; at most ``buckets`` numbers come to the driver."""
    return sorted(r[0] for r in df.select(bucket_of(key, buckets)).distinct().collect())


def _exists(spark: SparkSession, path: str) -> bool:
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    return folder.getFileSystem(spark._jsc.hadoopConfiguration()).exists(folder)


def read_buckets(spark: SparkSession, path: str, schema: str, only: list[int] | None = None) -> DataFrame:
    """The table without its bucket column; with only, those partitions alone are listed and read. A missing folder is an empty table."""
    if not _exists(spark, path):
        return spark.createDataFrame([], schema)
    df = spark.read.schema(f"{schema}, bucket int").parquet(path)
    return (df.where(F.col("bucket").isin(only)) if only is not None else df).drop("bucket")


def write_buckets(df: DataFrame, path: str, key: str = "key", buckets: int = BUCKETS) -> None:
    """Write df's buckets, one file each; buckets that df has no row of are left as they are."""
    rows = df.withColumn("bucket", bucket_of(key, buckets)).repartition("bucket")
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("bucket").parquet(path)


def upsert_buckets(spark: SparkSession, path: str, updates: DataFrame, schema: str, key: str = "key", buckets: int = BUCKETS) -> list[int]:
    """Set the updates' fields in the table at path, nulls included, and add new keys; returns the buckets it wrote.

    Other fields are kept. Doing it again changes nothing, so a run that failed halfway is repeated.
    """
    touched = touched_buckets(updates, key, buckets)
    if touched:
        held = read_buckets(spark, path, schema, touched)
        names = [f.strip().split()[0] for f in schema.split(",")]
        write_buckets(merge_upsert(held, updates, key).select(*names), path, key, buckets)
    return touched


FINGERPRINTS = "feed string, key string, md5 string"


def publish_changes(spark: SparkSession, df: DataFrame, feed: str, columns: list[str], target: str, state: str, schema: str, buckets: int = BUCKETS) -> int:
    """Send the rows of df (by column key) that are new or differ from the feed's fingerprints; returns how many.

    Only the state's buckets of df's keys are read. The target is written before the state: if the run stops between
    the two, the next one sends the same rows again.
    """
    path = f"{state}/{feed}"
    old = read_buckets(spark, path, FINGERPRINTS, touched_buckets(df, "key", buckets))
    changed = changed_rows(df.select("key", *columns), old, feed, columns).persist()
    try:
        found = changed.count()
        if found:
            upsert_buckets(spark, target, changed.drop("md5"), schema, "key", buckets)
            marks = changed.select(F.lit(feed).alias("feed"), "key", "md5")
            upsert_buckets(spark, path, marks, FINGERPRINTS, "key", buckets)
    finally:
        changed.unpersist()
    return found
