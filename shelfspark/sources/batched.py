"""A sink that hands rows to an external store in batches, with a ledger that makes retried tasks and runs idempotent.

``df.write.format("batched_sink").option("client", "module:function").option("ledger", folder).option("run", id)``

The client is a function of (batch: list of dicts) that the executors import. Rows go in batches of ``size``, 400 unless
told. A batch is named by the digest of its rows; when the client has taken it, its name is put into the ledger's folder
of the run. A task that is retried, or the same run started again, makes the same batches from the same rows and leaves
out those in the ledger. A batch that was sent but not noted, because its task died in between, is sent again: the
client must take the same row twice. Rows are grouped by hash of ``key`` if given, and sorted, so that batches do not
depend on the order in which rows arrive.

The run's end is one file: ``committed.json`` with the numbers of batches and rows, or ``aborted.json`` when a task failed
for good; a commit after an abort removes it.
"""

from __future__ import annotations

import hashlib
import importlib
import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

from pyarrow import fs
from pyspark.sql import DataFrame, Row
from pyspark.sql.datasource import DataSource, DataSourceWriter, WriterCommitMessage

SIZE = 400


def _open(uri: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(uri) if "://" in uri or uri.startswith("file:") else (fs.LocalFileSystem(), uri)


def _put(uri: str, name: str, text: str) -> None:
    """One whole file; its name appears when all of it is there."""
    system, path = _open(uri)
    system.create_dir(path, recursive=True)
    part = f"{path}/.{name}.{uuid.uuid4().hex}"
    with system.open_output_stream(part) as out:
        out.write(text.encode())
    system.move(part, f"{path}/{name}")


def _there(uri: str, name: str) -> bool:
    system, path = _open(uri)
    return system.get_file_info(f"{path}/{name}").type == fs.FileType.File


def _client(name: str):
    module, function = name.split(":")
    return getattr(importlib.import_module(module), function)


@dataclass
class Sent(WriterCommitMessage):
    """What one task has done: batches and rows in all, and batches left out because the ledger had them."""

    batches: int
    rows: int
    skipped: int


class _Writer(DataSourceWriter):
    def __init__(self, client: str, ledger: str, run: str, size: int):
        self.client, self.size = client, size
        self.folder = f"{ledger.rstrip('/')}/{run}"

    def write(self, rows: Iterator[Row]) -> Sent:
        send, sent = _client(self.client), Sent(0, 0, 0)
        batch: list[dict] = []

        def flush() -> None:
            text = json.dumps(batch, default=str, sort_keys=True)
            name = hashlib.sha256(text.encode()).hexdigest()
            if _there(self.folder, name):
                sent.skipped += 1
            else:
                send(batch)
                _put(self.folder, name, str(len(batch)))
            sent.batches += 1
            sent.rows += len(batch)

        for row in rows:
            batch.append(row.asDict(recursive=True))
            if len(batch) == self.size:
                flush()
                batch = []
        if batch:
            flush()
        return sent

    def _end(self, name: str, messages: list[Sent | None]) -> None:
        done = [m for m in messages if m is not None]
        totals = {f: sum(getattr(m, f) for m in done) for f in ("batches", "rows", "skipped")}
        _put(self.folder, name, json.dumps(totals))

    def commit(self, messages: list[Sent | None]) -> None:
        self._end("committed.json", messages)
        if _there(self.folder, "aborted.json"):
            system, path = _open(self.folder)
            system.delete_file(f"{path}/aborted.json")

    def abort(self, messages: list[Sent | None]) -> None:
        self._end("aborted.json", messages)


class BatchedSink(DataSource):
    @classmethod
    def name(cls) -> str:
        return "batched_sink"

    def writer(self, schema, overwrite):
        o = self.options
        return _Writer(o["client"], o["ledger"], o["run"], int(o.get("size", SIZE)))


def send_batches(df: DataFrame, client: str, ledger: str, run: str, key: str | None = None, size: int = SIZE, parts: int | None = None) -> None:
    """Send df's rows through the batched sink; started again with the same run, it sends what is missing.

    With key, rows are dealt by its hash and sorted by all columns that can be, so the batches are the same each time.
    """
    df.sparkSession.dataSource.register(BatchedSink)
    if key:
        order = [key, *[f.name for f in df.schema if f.name != key and f.dataType.typeName() not in ("map", "variant")]]
        df = (df.repartition(parts, key) if parts else df.repartition(key)).sortWithinPartitions(*order)
    df.write.format("batched_sink").mode("append").options(client=client, ledger=ledger, run=run, size=size).save()
