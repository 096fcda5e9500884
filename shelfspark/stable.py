"""Results that must not be computed twice, in the folder that driver and executors share."""

from __future__ import annotations

import tempfile

from pyspark.sql import DataFrame, SparkSession


def checkpoint_dir(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; where it names none, a local folder on one machine, as in tests, and an error on a cluster."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not found and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
    if not spark.sparkContext.getCheckpointDir():
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def settled(df: DataFrame) -> DataFrame:
    """df computed once and read back from the checkpoint folder, so that row placement cannot change between two uses."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
