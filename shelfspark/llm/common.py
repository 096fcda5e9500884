"""Shared folder, saved tables and column helpers."""

from __future__ import annotations

import os
import shutil
import tempfile
import uuid
import weakref
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: White space of the word rules: blank, tab, line feed, vertical tab, form feed, return.
SPACES = r"[\x20\x09-\x0D]"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share, from ``spark.checkpoint.dir``.

    Only where the session names none and runs on one machine, as in tests, a local one is made and set.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if not found:
        found = spark.sparkContext.getCheckpointDir()
    if not found and spark.sparkContext.master.partition("[")[0] != "local":
        raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
    if not found:
        found = "file://" + tempfile.mkdtemp(prefix="spark-shared-")
        spark.sparkContext.setCheckpointDir(found)
    return found.rstrip("/")


def fresh_path(spark: SparkSession, name: str) -> str:
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


#: Lets Spark delete the shuffle files of a query as soon as its result stands.
_SHUFFLES_GO = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
#: Folders of saved tables, and the tables that each open ``scratch`` holds.
_FOLDERS: weakref.WeakKeyDictionary[DataFrame, str] = weakref.WeakKeyDictionary()
_OPEN: ContextVar[tuple[list[DataFrame], ...]] = ContextVar("open", default=())


def saved(df: DataFrame, name: str, outer: bool = False) -> DataFrame:
    """Write df as a table in the shared folder and read it back: cuts the lineage, survives lost executors.

    The shuffle files behind it go at once. Inside a ``scratch`` the table goes at its end; with outer it
    belongs to the scratch around that one, or stays if there is none.
    """
    spark = df.sparkSession
    path = fresh_path(spark, name)
    before = spark.conf.get(_SHUFFLES_GO, "false")
    spark.conf.set(_SHUFFLES_GO, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(_SHUFFLES_GO, before)
    table = spark.read.schema(df.schema).parquet(path)
    _FOLDERS[table] = path
    owners = _OPEN.get()[:-1] if outer else _OPEN.get()
    if owners:
        owners[-1].append(table)
    return table


def discard(*tables: DataFrame) -> None:
    """Delete saved tables that nothing reads any more."""
    for table in tables:
        if path := _FOLDERS.pop(table, None):
            spark = table.sparkSession
            folder = spark._jvm.org.apache.hadoop.fs.Path(path)
            folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch() -> Iterator[None]:
    """Tables that are saved inside, in this thread, are deleted at the end."""
    mine: list[DataFrame] = []
    before = _OPEN.set((*_OPEN.get(), mine))
    try:
        yield
    finally:
        _OPEN.reset(before)
        discard(*mine)


def doc_key() -> Column:
    """A document's key: its number with its text, so that repeated numbers stay apart."""
    return F.xxhash64(F.col("doc_id"), F.coalesce(F.col("text"), F.lit("")))


def free_name(columns: list[str], name: str) -> str:
    """name, with as many underscores behind it as no column has."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


#: Bits of a table of numbers, at most; with more numbers than a sixteenth of it, more pass that are not meant.
MOST_BITS = 1 << 26


class BitTable:
    """Tells which 64-bit numbers may be among those of a table: a hash bit each. Goes to the tasks as a broadcast of at most MOST_BITS bits."""

    def __init__(self, nodes: DataFrame):
        """nodes: a column of whole numbers that are hashes already."""
        n = nodes.count()
        self.size = min(MOST_BITS, max(1 << 16, 1 << (16 * n).bit_length()))
        slot = F.col(nodes.columns[0]).bitwiseAND(F.lit(self.size - 1))
        words = nodes.select(F.shiftright(slot, 6).alias("w"), F.call_function("shiftleft", F.lit(1).cast("long"), (slot % 64).cast("int")).alias("b"))
        found = words.groupBy("w").agg(F.bit_or("b").alias("b")).toArrow()
        self.bits = np.zeros(self.size // 64, np.uint64)
        self.bits[found["w"].to_numpy()] = found["b"].to_numpy().view(np.uint64)

    def has(self, nodes: np.ndarray) -> np.ndarray:
        slot = nodes.view(np.uint64) & np.uint64(self.size - 1)
        return (self.bits[slot >> np.uint64(6)] >> (slot & np.uint64(63))) & np.uint64(1) > 0


_KEPT: dict[str, dict] = {}


def worker_tables(owner: str) -> dict:
    """What a Python worker keeps from task to task for one operator. Workers serve all operators in turn, so what others kept goes."""
    if owner not in _KEPT:
        _KEPT.clear()
        _KEPT[owner] = {}
    return _KEPT[owner]


_SHIPPED: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors' Python workers, once an application."""
    context = spark.sparkContext
    if context.applicationId not in _SHIPPED:
        package = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
        name = os.path.join(tempfile.mkdtemp(prefix="spark-ship-"), os.path.basename(package))
        context.addPyFile(shutil.make_archive(name, "zip", os.path.dirname(package), os.path.basename(package)))
        _SHIPPED.add(context.applicationId)
