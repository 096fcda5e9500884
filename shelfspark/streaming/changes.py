"""Changed rows of a stream by keyed state: the fingerprint of each key's last row, in a state store."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import timedelta

from pyspark.sql import DataFrame, Row
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from ..functions.columns import fingerprint
from ..sources.buckets import BUCKETS, upsert_buckets

_STORE = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


class _Changed(StatefulProcessor):
    """Holds one md5 a key; of a key's rows in a batch the last by ordinal counts."""

    def __init__(self, ordinal: str, ttl: timedelta | None):
        self.ordinal, self.ttl = ordinal, ttl

    def init(self, handle: StatefulProcessorHandle) -> None:
        millis = int(self.ttl.total_seconds() * 1000) if self.ttl else None
        self.held = handle.getValueState("fingerprint", "md5 string", millis)

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        last = max(rows, key=lambda r: (r[self.ordinal] is not None, r[self.ordinal] or 0, r["md5"]))
        if not self.held.exists() or self.held.get()[0] != last["md5"]:
            self.held.update((last["md5"],))
            yield last

    def close(self) -> None:
        pass


def changed_stream(stream: DataFrame, columns: list[str], ordinal: str, key: str = "key", ttl: timedelta | None = None) -> DataFrame:
    """The stream's rows whose fingerprint over columns is new or differs from the key's last one; with their md5.

    A batch that comes again, in a new file or after a restart from the checkpoint, changes nothing. With ttl, a key not
    changed for that long is forgotten, and its next row counts as new.
    """
    stream.sparkSession.conf.set(_STORE, _ROCKS)  # keyed state with more than one column family needs this store
    marked = stream.where(f"{key} is not null").withColumn("md5", fingerprint(*columns))
    processor = _Changed(ordinal, ttl)
    return marked.groupBy(key).transformWithState(processor, marked.schema, "Update", "ProcessingTime" if ttl else "None")


def upsert_batch(target: str, schema: str, key: str = "key", buckets: int = BUCKETS):
    """A foreachBatch writer: the batch's fields are set in the bucketed table at target; a batch done twice changes nothing."""
    names = [f.strip().split()[0] for f in schema.split(",")]

    def write(batch: DataFrame, _: int) -> None:
        batch = batch.select(*[n for n in names if n in batch.columns]).persist()
        try:
            upsert_buckets(batch.sparkSession, target, batch, schema, key, buckets)
        finally:
            batch.unpersist()

    return write
