"""Words of Arrow text columns as numpy arrays: splitting and 64-bit hashing without a loop over words."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Text bytes that are worked on at once; a longer single text makes a slice of its own.
SLICE_BYTES = 3 << 20

_M1, _M2, _M3 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
_MASKS = np.array([(1 << 8 * k) - 1 for k in range(9)], dtype=np.uint64)


def slices(batches: Iterator[pa.RecordBatch], text: str = "text", limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``limit`` bytes of text; null texts become empty."""
    for batch in batches:
        if not batch.num_rows:
            continue
        at = batch.schema.get_field_index(text)
        filled = pc.fill_null(batch.column(at).cast(pa.string()), "")
        batch = batch.set_column(at, pa.field(text, pa.string()), filled)
        sizes = np.cumsum(pc.binary_length(filled).to_numpy(zero_copy_only=False))
        start = 0
        while start < batch.num_rows:
            before = sizes[start - 1] if start else 0
            end = max(start + 1, int(np.searchsorted(sizes, before + limit, side="right")))
            yield batch.slice(start, end - start)
            start = end


def offsets_of(lists: pa.ListArray) -> np.ndarray:
    """Offsets that start at 0, also for a sliced array."""
    o = lists.offsets.to_numpy().astype(np.int64)
    return o - o[0]


def drop_empty(offsets: np.ndarray, flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Offsets and items without the empty strings."""
    full = pc.binary_length(flat).to_numpy(zero_copy_only=False) > 0
    if full.all():
        return offsets, flat
    return np.concatenate([[0], np.cumsum(full)])[offsets], flat.filter(pa.array(full))


def split_words(texts: pa.Array, lower: bool = True) -> tuple[np.ndarray, pa.Array]:
    """Offsets per text, and all words: runs without blank, tab, line or page break; A-Z in lower case."""
    lists = pc.ascii_split_whitespace(pc.ascii_lower(texts) if lower else texts)
    return drop_empty(offsets_of(lists), lists.flatten())


def hash_strings(flat: pa.Array) -> np.ndarray:
    """A 64-bit hash of each string, eight bytes a round for all strings together."""
    if not len(flat):
        return np.zeros(0, np.uint64)
    _, offs, data = flat.buffers()
    o = np.frombuffer(offs, dtype=np.int32)[flat.offset : flat.offset + len(flat) + 1].astype(np.int64)
    first, last = int(o[0]), int(o[-1])
    raw = np.zeros(last - first + 8, np.uint8)
    if last > first:
        raw[:-8] = np.frombuffer(data, dtype=np.uint8)[first:last]
    loads = np.ndarray(shape=(len(raw) - 7,), dtype="<u8", buffer=raw, strides=(1,))
    at, left = o[:-1] - first, np.diff(o)
    h = left.astype(np.uint64) * _M1
    open_ = np.arange(len(left))
    while len(open_):
        h[open_] = mixed(h[open_] ^ (loads[at[open_]] & _MASKS[np.minimum(left[open_], 8)]))
        open_ = open_[left[open_] > 8]
        at[open_] += 8
        left[open_] -= 8
    return h


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingles(offsets: np.ndarray, words: np.ndarray, k: int = 5) -> tuple[np.ndarray, np.ndarray]:
    """Offsets per text and the hash of every k-word window; a shorter text is one window of all its words."""
    n = np.diff(offsets)
    counts = np.where(n >= k, n - k + 1, np.minimum(n, 1))
    out = np.concatenate([[0], np.cumsum(counts)])
    starts = np.repeat(offsets[:-1], counts) + np.arange(out[-1]) - np.repeat(out[:-1], counts)
    padded = np.concatenate([words, np.zeros(k, np.uint64)])
    # A short text's window must not reach into the next text.
    room = np.repeat(np.minimum(n, k), counts)
    h = room.astype(np.uint64)
    for j in range(k):
        h = h * _M1 + np.where(j < room, padded[starts + j], np.uint64(j))
    return out, mixed(h)


def distinct_sorted(offsets: np.ndarray, items: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each text's distinct items in ascending order; works in place on ``items``."""
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        items[a:b].sort()
    new = np.ones(len(items), bool)
    new[1:] = items[1:] != items[:-1]
    new[offsets[:-1][offsets[:-1] < len(items)]] = True
    return np.concatenate([[0], np.cumsum(new)])[offsets], items[new]


def sums(offsets: np.ndarray, items: np.ndarray) -> np.ndarray:
    """The sum of each text's items, 0 for none, modulo 2**64."""
    total = np.concatenate([np.zeros(1, items.dtype), np.cumsum(items, dtype=items.dtype)])
    return total[offsets[1:]] - total[offsets[:-1]]
