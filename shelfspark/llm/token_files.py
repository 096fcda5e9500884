"""Token ids of documents as binary files with Elias-Fano document boundaries.

Documents are dealt to tasks by ranges of doc_id and sorted there; each task encodes
its texts and writes files of a few million ids. A file holds a header, the doc_ids
(Elias-Fano), the ends of the documents (Elias-Fano) and one array of ids of 16 or 32
bits. No table of 64-bit offsets is kept: ``TokenFile.span`` selects in the ends. How
many ids lie before a file comes from the sums of the tasks before it, not from one
task that sees all files.

Edge cases: a null text has only the end id; null doc_ids come first and are marked by
count; repeated rows follow one another; an empty table gives no file and no rows.
"""

from __future__ import annotations

import os
import re
import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from . import files
from .common import fresh_path, saved
from .elias_fano import EliasFano
from .pieces import PieceTable
from .words import slices

MAGIC = b"EFTOKEN1"
_HEAD = struct.Struct("<8sQQQ")
#: A file is closed when it has this many ids.
FILE_IDS = 4 << 20
END_ID = 0


def pack(doc_ids: list[int | None], ids: list[np.ndarray], width: int) -> bytes:
    """One file: documents in ascending order of doc_id, nulls first."""
    nulls = sum(x is None for x in doc_ids)
    known = EliasFano.build(np.array(doc_ids[nulls:], dtype=np.int64))
    ends = EliasFano.build(np.cumsum([len(x) for x in ids], dtype=np.int64))
    flat = np.concatenate(ids)
    if len(flat) and int(flat.max()) >> 8 * width:
        raise ValueError(f"id {int(flat.max())} does not fit {width} bytes")
    flat = flat.astype(f"<u{width}")
    return _HEAD.pack(MAGIC, len(ids), nulls, width) + known.to_bytes() + ends.to_bytes() + flat.tobytes()


class TokenFile:
    """Reads a file's bytes in place."""

    def __init__(self, data):
        self.data = memoryview(data)
        magic, self.n_docs, self.nulls, self.width = _HEAD.unpack_from(self.data, 0)
        if magic != MAGIC:
            raise ValueError("not a token file")
        self.known, at = EliasFano.from_buffer(self.data, _HEAD.size)
        self.ends, self.at = EliasFano.from_buffer(self.data, at)

    def span(self, k: int) -> tuple[int, int]:
        """Where the ids of the k-th document begin and end, by select."""
        return self.ends.select(k - 1) if k else 0, self.ends.select(k)

    def spans(self) -> Iterator[np.ndarray]:
        """The ends of the documents in order, from one select sample to the next."""
        return (self.ends.stretch(s) for s in range(len(self.ends.samples)))

    def ids(self, start: int, end: int) -> np.ndarray:
        return np.frombuffer(self.data, f"<u{self.width}", end - start, self.at + start * self.width)

    def doc_ids(self) -> list[int | None]:
        return [None] * self.nulls + self.known.all().tolist()


#: A blank and Latin letters, by ranges that hold nothing else.
_WORD = re.compile(" ?[A-Za-z\xc0-\xd6\xd8-\xf6\xf8-\u024f]+")
#: The letter that stands for each byte in byte-level vocabularies: itself if it can be seen, else the next one from 256 on.
_SEEN = {*range(33, 127), *range(161, 173), *range(174, 256)}
_BYTES = {b: chr(256 + k) for k, b in enumerate(x for x in range(256) if x not in _SEEN)}
_TABLES: dict[str, PieceTable] = {}
#: The library's own tokenizer of this worker, and the contents of its added tokens.
_WHOLE: dict[str, tuple] = {}


def worker_table(path: str) -> PieceTable:
    """The tokenizer of this Python worker behind its table of pieces."""
    if path not in _TABLES:
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True

        model = tokenizer.model

        def encode(new: list[str]) -> list[list[int]]:
            """Ids of pieces. One of Latin letters is one match of the split pattern and goes to the model at once."""
            word, out = _WORD.fullmatch, [[]] * len(new)
            rest = []
            for i, piece in enumerate(new):
                if word(piece):
                    out[i] = [t.id for t in model.tokenize(piece.encode().decode("latin-1").translate(_BYTES))]
                else:
                    rest.append(i)
            for i, own in zip(rest, tokenizer.encode_batch_fast([new[i] for i in rest], add_special_tokens=False), strict=True):
                out[i] = own.ids
            return out

        _TABLES[path] = PieceTable(encode)
    return _TABLES[path]


def encode_texts(path: str, texts: pa.Array) -> list[np.ndarray]:
    """The ids of each text, as the library gives them without special tokens added.

    The library cuts a text at the contents of added tokens first; texts that hold one go to it whole.
    """
    out = list(worker_table(path)(texts))
    if path not in _WHOLE:
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        _WHOLE[path] = tokenizer, [t.content for t in tokenizer.get_added_tokens_decoder().values()]
    tokenizer, added = _WHOLE[path]
    for content in added:
        for i in np.flatnonzero(pc.match_substring(texts, content).to_numpy(zero_copy_only=False)):
            out[i] = np.array(tokenizer.encode(texts[int(i)].as_py(), add_special_tokens=False).ids, np.uint32)
    return out


def _writer(folder: str, path: str, width: int):
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        part, n = TaskContext.get().partitionId(), 0
        doc_ids: list = []
        held: list[np.ndarray] = []
        size = 0

        def close():
            name = f"part-{part:06d}-{n:06d}.tok"
            files.put(folder, name, pack(doc_ids, held, width))
            return pa.RecordBatch.from_pydict(
                {"file": [name], "part": pa.array([part], pa.int32()), "n": pa.array([n], pa.int32()), "n_docs": pa.array([len(held)], pa.int64()), "n_ids": pa.array([size], pa.int64())}
            )

        for batch in slices(batches):
            for doc_id, ids in zip(batch.column(0).to_pylist(), encode_texts(path, batch.column(1)), strict=True):
                doc_ids.append(doc_id)
                held.append(np.append(ids, np.uint32(END_ID)))
                size += len(held[-1])
                if size >= FILE_IDS:
                    yield close()
                    n, doc_ids, held, size = n + 1, [], [], 0
        if held:
            yield close()

    return write


def write_tokens(docs: DataFrame, folder: str, path: str, width: int = 2) -> DataFrame:
    """Write all documents' ids below folder. Returns the files: file, part, n, n_docs, n_ids, start."""
    files.make_folder(folder)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    order = [F.col("doc_id").asc_nulls_first(), F.xxhash64("text")]
    rows = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    made = saved(
        rows.mapInArrow(_writer(folder, path, width), "file string, part int, n int, n_docs long, n_ids long"), "token-files"
    )
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    parts = made.groupBy("part").agg(F.sum("n_ids").alias("total"))
    parts = parts.select("part", F.coalesce(F.sum("total").over(before), F.lit(0)).alias("offset"))
    inside = Window.partitionBy("part").orderBy("n").rowsBetween(Window.unboundedPreceding, -1)
    made = made.withColumn("inside", F.coalesce(F.sum("n_ids").over(inside), F.lit(0)))
    return made.join(parts, "part").withColumn("start", F.col("offset") + F.col("inside")).drop("offset", "inside")


def _read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for path, data in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            f = TokenFile(data.as_buffer())
            name, doc_ids, last = path.rpartition("/")[2], f.doc_ids(), 0
            for ends in f.spans():
                starts, n = np.concatenate([[last], ends[:-1]]), len(ends)
                crcs = [zlib.crc32(f.ids(a, b).astype("<u4").tobytes()) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)]
                mine, doc_ids, last = doc_ids[:n], doc_ids[n:], int(ends[-1])
                yield pa.RecordBatch.from_arrays(
                    [pa.array([name] * n), pa.array(mine, pa.int64()), pa.array(starts), pa.array(ends - starts), pa.array(crcs, pa.int64())],
                    names=["file", "doc_id", "inside", "n_tokens", "ids_crc32"],
                )


def read_tokens(spark: SparkSession, folder: str, made: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of every document, from the files."""
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tok").load(folder).select("path", "content")
    rows = raw.mapInArrow(_read, "file string, doc_id long, inside long, n_tokens long, ids_crc32 long")
    return rows.join(made.select("file", "start"), "file").select(
        "doc_id", (F.col("start") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32"
    )


def op9_token_files(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    folder = fresh_path(spark, "tokens")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return read_tokens(spark, folder, write_tokens(docs, folder, public_tokenizers.path("byte_bpe_50k.json")))
