"""Receipt files as a Python data source: any width, quoted line breaks, whole files a partition.

``spark.read.format("receipt_files").load(folder)`` gives file, line (of the record's first line, from 0) and cells, all
text. Blank lines and rows of blank cells go; so do columns that are blank in the whole file, wherever they stand, told
by a bit mask of the file's columns that a first pass over it makes. Temporary files (~$), hidden files and folders are
skipped. A file is read twice in a stream and never held; small files share a partition, a file is never split.

As a stream, files come in order of their time of change and name; one that is delivered with an older time than the
last one read is not seen, so files must get their time when they are put into the folder.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, DataSourceStreamReader, InputPartition

SCHEMA = "file string, line int, cells array<string>"
_ARROW = pa.schema([("file", pa.string()), ("line", pa.int32()), ("cells", pa.list_(pa.string()))])
#: Bytes and files in one partition, and rows in one batch.
PACK_BYTES, PACK_FILES, BATCH = 32 << 20, 200, 2000

csv.field_size_limit(1 << 30)


def records(text: Iterable[str]) -> Iterator[tuple[int, list[str]]]:
    """The number of the first line and the cells of each record that has a cell that is not blank."""
    reader, line = csv.reader(text), 0
    for cells in reader:
        if any(c.strip() for c in cells):
            yield line, cells
        line = reader.line_num


def used_columns(rows: Iterable[tuple[int, list[str]]]) -> int:
    """Bit i is set if a row has a cell i that is not blank."""
    mask = 0
    for _, cells in rows:
        for i, c in enumerate(cells):
            if c.strip():
                mask |= 1 << i
    return mask


def sheet(open_text) -> Iterator[tuple[int, list[str]]]:
    """Lines and cells of one file, without its blank columns; open_text gives the file's text anew at each call."""
    mask = used_columns(records(open_text()))
    for line, cells in records(open_text()):
        yield line, [c for i, c in enumerate(cells) if mask >> i & 1]


def sheet_of_text(text: str) -> Iterator[tuple[int, list[str]]]:
    return sheet(lambda: io.StringIO(text.removeprefix("﻿"), newline=""))


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _found(path: str) -> list[tuple[int, str, int]]:
    """Time of change, path and bytes of the files below a folder."""
    system, root = _system(path)
    infos = system.get_file_info(fs.FileSelector(root, recursive=True))
    hidden = lambda p: any(part.startswith((".", "_", "~$")) for part in p[len(root) :].split("/"))
    return sorted((i.mtime_ns or 0, i.path, i.size or 0) for i in infos if i.type == fs.FileType.File and not hidden(i.path))


class _Files(InputPartition):
    def __init__(self, paths: list[str]):
        super().__init__(None)
        self.paths = paths


def _packed(found: list[tuple[int, str, int]]) -> list[_Files]:
    packs, size = [[]], 0
    for _, path, n in found:
        if packs[-1] and (size + n > PACK_BYTES or len(packs[-1]) >= PACK_FILES):
            packs.append([])
            size = 0
        packs[-1].append(path)
        size += n
    return [_Files(p) for p in packs if p]


def _read(root: str, partition: _Files) -> Iterator[pa.RecordBatch]:
    system, _ = _system(root)
    files, lines, cells = [], [], []
    for path in partition.paths:
        text = lambda path=path: io.TextIOWrapper(system.open_input_stream(path), "utf-8-sig", "replace", newline="")
        for line, row in sheet(text):
            files.append(path.rsplit("/", 1)[-1])
            lines.append(line)
            cells.append(row)
            if len(files) >= BATCH:
                yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(lines, pa.int32()), pa.array(cells, pa.list_(pa.string()))], schema=_ARROW)
                files, lines, cells = [], [], []
    if files:
        yield pa.RecordBatch.from_arrays([pa.array(files), pa.array(lines, pa.int32()), pa.array(cells, pa.list_(pa.string()))], schema=_ARROW)


class _Reader(DataSourceReader):
    def __init__(self, path: str):
        self.path = path

    def partitions(self):
        return _packed(_found(self.path))

    def read(self, partition):
        return _read(self.path, partition)


class _StreamReader(DataSourceStreamReader):
    def __init__(self, path: str):
        self.path = path

    def initialOffset(self) -> dict:
        return {"time": -1, "path": ""}

    def latestOffset(self) -> dict:
        found = _found(self.path)
        return {"time": found[-1][0], "path": found[-1][1]} if found else self.initialOffset()

    def partitions(self, start: dict, end: dict):
        low, high = (start["time"], start["path"]), (end["time"], end["path"])
        return _packed([f for f in _found(self.path) if low < f[:2] <= high])

    def read(self, partition):
        return _read(self.path, partition)


class ReceiptFiles(DataSource):
    @classmethod
    def name(cls) -> str:
        return "receipt_files"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema):
        return _Reader(self.options["path"])

    def streamReader(self, schema):
        return _StreamReader(self.options["path"])


def read_receipt_lines(spark: SparkSession, folder: str) -> DataFrame:
    """All receipt files below a folder as file, line, cells."""
    spark.dataSource.register(ReceiptFiles)
    return spark.read.format("receipt_files").load(folder)


def stream_receipt_lines(spark: SparkSession, folder: str) -> DataFrame:
    spark.dataSource.register(ReceiptFiles)
    return spark.readStream.format("receipt_files").load(folder)
