"""Byte-level BPE encoding and decoding by dynamic programming over byte prefixes.

Each byte prefix of a pretoken has one valid encoding, and so one last token. Token
t ends the prefix at i when t is a suffix of it and may stand after the last token
of the prefix before t; two tokens may stand together when merging their joined
bytes gives just these two. With the last tokens stored, bytes are appended at the
cost of the new bytes, and an edit redoes only what follows it.

Edge cases: null text is the empty text and has no ids; the strings of special
tokens are ordinary text; very long pretokens cost their length times the longest
token; an empty table gives an empty table.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import worker_tables
from .pieces import PieceTable
from .words import slices

#: Pairs of tokens whose verdict, and short prefixes whose last token, one Python worker keeps.
MOST_PAIRS, MOST_PREFIXES = 600_000, 600_000
#: Pretokens up to this many bytes share the table of prefixes; a longer one has its own list.
SHORT = 48


def read_ranks(path: str) -> dict[bytes, int]:
    with open(path, "rb") as f:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}


class PrefixEncoder:
    def __init__(self, ranks: dict[bytes, int], pattern: str):
        self.ranks, self.split = ranks, regex.compile(pattern)
        self.tokens = [b""] * (max(ranks.values()) + 1)
        for token, i in ranks.items():
            self.tokens[i] = token
        self.longest = max(map(len, ranks))
        self.pairs: dict[tuple[int, int], bool] = {}
        self.prefixes: dict[bytes, int] = {}

    def merge(self, data: bytes) -> list[int]:
        """Plain BPE: join the adjacent parts of the lowest rank, the leftmost first, until none can be joined."""
        parts, ranks = [data[i : i + 1] for i in range(len(data))], self.ranks
        scores = [ranks.get(a + b, 1 << 40) for a, b in zip(parts, parts[1:])]
        while scores and (best := min(scores)) < 1 << 40:
            i = scores.index(best)
            parts[i : i + 2] = [parts[i] + parts[i + 1]]
            del scores[i]
            if i:
                scores[i - 1] = ranks.get(parts[i - 1] + parts[i], 1 << 40)
            if i < len(scores):
                scores[i] = ranks.get(parts[i] + parts[i + 1], 1 << 40)
        return [ranks[p] for p in parts]

    def fits(self, a: int, b: int) -> bool:
        """Whether token b may stand right after token a."""
        if (found := self.pairs.get((a, b))) is None:
            if len(self.pairs) >= MOST_PAIRS:
                self.pairs.clear()
            found = self.pairs[a, b] = self.merge(self.tokens[a] + self.tokens[b]) == [a, b]
        return found

    def extend(self, data: bytes, last: list[int]) -> list[int]:
        """Complete ``last``, the last token of each prefix; it may hold those of a shorter prefix already."""
        ranks, pairs = self.ranks, self.pairs
        for end in range(len(last) + 1, len(data) + 1):
            for start in range(max(0, end - self.longest), end):
                token = ranks.get(data[start:end])
                if token is not None and (not start or (pairs.get((last[start - 1], token)) or self.fits(last[start - 1], token))):
                    last.append(token)
                    break
        return last

    def walk(self, last: list[int]) -> list[int]:
        """The ids that the stored last tokens stand for."""
        out, at = [], len(last)
        while at:
            out.append(last[at - 1])
            at -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode_pretoken(self, data: bytes) -> list[int]:
        """The ids of one pretoken, from the longest prefix whose last tokens are stored."""
        token = self.ranks.get(data)
        if token is not None:
            return [token]
        if len(data) > SHORT:
            return self.walk(self.extend(data, []))
        ranks, stored, pairs = self.ranks, self.prefixes, self.pairs
        if len(stored) > MOST_PREFIXES:
            stored.clear()
        end = len(data)
        while end and data[:end] not in stored:
            end -= 1
        for end in range(end + 1, len(data) + 1):
            prefix = data[:end]
            token = ranks.get(prefix)
            start = 0
            while token is None:
                start += 1
                token = ranks.get(data[start:end])
                if token is not None:
                    before = stored[data[:start]]
                    good = pairs.get((before, token))
                    if not (self.fits(before, token) if good is None else good):
                        token = None
            stored[prefix] = token
        out = []
        while end:
            out.append(stored[data[:end]])
            end -= len(self.tokens[out[-1]])
        return out[::-1]

    def encode(self, text: str) -> list[int]:
        return [i for p in self.split.findall(text) for i in self.encode_pretoken(p.encode())]

    def encode_many(self, texts: list[str]) -> list[list[int]]:
        """Each text's ids; a pretoken that comes twice is encoded once."""
        seen: dict[str, list[int]] = {}
        out = []
        for text in texts:
            ids = []
            for p in self.split.findall(text):
                if (one := seen.get(p)) is None:
                    one = seen[p] = self.encode_pretoken(p.encode())
                ids += one
            out.append(ids)
        return out

    def decode(self, ids) -> bytes:
        return b"".join(map(self.tokens.__getitem__, ids))


class Editable:
    """A text whose ids follow appends and edits without encoding it all again."""

    #: Characters before the end on which a match of the split pattern may still depend.
    REACH = 4

    def __init__(self, encoder: PrefixEncoder, text: str = ""):
        self.encoder, self.text, self.ends, self.last = encoder, "", [], []
        self.append(text)

    def ids(self) -> list[int]:
        return [i for last in self.last for i in self.encoder.walk(last)]

    def append(self, more: str) -> None:
        self.replace(len(self.text), len(self.text), more)

    def replace(self, start: int, end: int, new: str) -> None:
        """Put ``new`` in place of text[start:end]; pretokens before and after that stay as they are are kept."""
        text = self.text[:start] + new + self.text[end:]
        shift = len(new) - (end - start)
        keep = 0
        while keep < len(self.ends) and self.ends[keep] <= start - self.REACH:
            keep += 1
        at = self.ends[keep - 1] if keep else 0
        old = {e + shift: k for k, e in enumerate(self.ends) if e >= end}
        ends, last = self.ends[:keep], self.last[:keep]
        before = self.last[keep] if keep < len(self.last) else []
        for m in self.encoder.split.finditer(text, at):
            data = m[0].encode()
            known = self.encoder.walk(before) if before else []
            was = self.encoder.decode(known)
            same = 0
            while same < min(len(was), len(data)) and was[same] == data[same]:
                same += 1
            last.append(self.encoder.extend(data, before[:same]))
            before = []
            ends.append(m.end())
            if m.end() >= start + len(new) and m.end() in old:  # from here on nothing differs
                k = old[m.end()]
                ends += [e + shift for e in self.ends[k + 1 :]]
                last += self.last[k + 1 :]
                break
        self.text, self.ends, self.last = text, ends, last


def worker_encoder(path: str, pattern: str) -> tuple[PrefixEncoder, PieceTable]:
    """The encoder of this Python worker, with the pieces it has met."""
    encoders = worker_tables("bpe")
    if (path, pattern) not in encoders:
        encoder = PrefixEncoder(read_ranks(path), pattern)
        encoders[path, pattern] = encoder, PieceTable(encoder.encode_many)
    return encoders[path, pattern]


def encode_documents(docs: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """key and ids (an array of int) of every whole text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, table = worker_encoder(path, pattern)
        for batch in slices(batches):
            ids = table(batch.column(1))
            offsets = np.concatenate([[0], np.cumsum([len(x) for x in ids])]).astype(np.int32)
            flat = np.concatenate(ids).astype(np.int32) if ids else np.zeros(0, np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(flat))
            yield pa.RecordBatch.from_arrays([batch.column(0), lists], names=[key, "ids"])

    return docs.select(key, "text").mapInArrow(run, f"{key} {docs.schema[key].dataType.simpleString()}, ids array<int>")


def decode_documents(encoded: DataFrame, path: str, pattern: str, key: str = "doc_id") -> DataFrame:
    """key and the decoded bytes of arrays of ids."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, _ = worker_encoder(path, pattern)
        for batch in batches:
            data = [encoder.decode(x or []) for x in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(data, pa.binary())], names=[key, "decoded"])

    return encoded.select(key, "ids").mapInArrow(run, f"{key} {encoded.schema[key].dataType.simpleString()}, decoded binary")


def encode_digests(docs: DataFrame, path: str, pattern: str) -> DataFrame:
    """doc_id, n_tokens, ids_sha256 and, after decoding the ids again, decoded_sha256."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, table = worker_encoder(path, pattern)
        decimal = [str(i) for i in range(len(encoder.tokens))]
        for batch in slices(batches):
            n, a, b = [], [], []
            for ids in table(batch.column(1)):
                ids = ids.tolist()
                n.append(len(ids))
                a.append(hashlib.sha256(" ".join(map(decimal.__getitem__, ids)).encode()).hexdigest())
                b.append(hashlib.sha256(encoder.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(pa.int64()), pa.array(n, pa.int64()), pa.array(a, pa.string()), pa.array(b, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(
        run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string"
    )


def op4_byte_bpe(spark, sf_dir) -> DataFrame:
    import public_tokenizers

    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return encode_digests(docs, public_tokenizers.path("byte_bpe_50k.tiktoken"), public_tokenizers.PATTERN)
