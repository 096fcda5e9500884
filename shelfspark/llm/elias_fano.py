"""Elias-Fano coding of non-decreasing whole numbers, with select.

Each number keeps its L low bits in a packed array; the high parts stand in unary in
a bit string in which the i-th one is at place high(i) + i. The place of every 256th
one is kept in a 32-bit sample, so select(i) reads a few bytes. With n numbers up to
u this takes about n * (2 + log2(u / n)) bits.
"""

from __future__ import annotations

import struct

import numpy as np

SAMPLE = 256
_HEAD = struct.Struct("<QQqB7x")


class EliasFano:
    def __init__(self, n: int, universe: int, base: int, low_bits: int, low: np.ndarray, high: np.ndarray, samples: np.ndarray):
        self.n, self.universe, self.base, self.low_bits = n, universe, base, low_bits
        self.low, self.high, self.samples = low, high, samples

    @classmethod
    def build(cls, numbers: np.ndarray) -> EliasFano:
        x = np.asarray(numbers, dtype=np.int64)
        n, base = len(x), int(x[0]) if len(x) else 0
        if n and (np.diff(x) < 0).any():
            raise ValueError("numbers must not decrease")
        x = (x - base).astype(np.uint64)
        universe = int(x[-1]) + 1 if n else 0
        bits = max(0, (universe // n).bit_length() - 1) if n else 0
        low = x & np.uint64((1 << bits) - 1)
        each = ((low[:, None] >> np.arange(bits, dtype=np.uint64)) & np.uint64(1)).astype(np.uint8)
        places = (x >> np.uint64(bits)).astype(np.int64) + np.arange(n)
        ones = np.zeros(int(places[-1]) + 1 if n else 0, np.uint8)
        ones[places] = 1
        return cls(
            n, universe, base, bits, np.packbits(each.ravel(), bitorder="little"),
            np.packbits(ones, bitorder="little"), places[::SAMPLE].astype(np.uint32),
        )

    def select(self, i: int) -> int:
        """The i-th number, from a sample and a scan of the bits behind it."""
        if not 0 <= i < self.n:
            raise IndexError(i)
        place, left, size = int(self.samples[i // SAMPLE]), i % SAMPLE, 64
        while left:
            byte = place // 8
            bits = np.unpackbits(self.high[byte : byte + size], bitorder="little")
            bits[: place % 8 + 1] = 0
            ones = np.flatnonzero(bits)
            if len(ones) >= left:
                place, left = byte * 8 + int(ones[left - 1]), 0
            size *= 4
        return self.base + ((place - i) << self.low_bits | self._low(i))

    def stretch(self, sample: int) -> np.ndarray:
        """The numbers from one sample to the next: select for SAMPLE of them at once."""
        first = sample * SAMPLE
        n = min(SAMPLE, self.n - first)
        begin = int(self.samples[sample])
        end = int(self.samples[sample + 1]) if sample + 1 < len(self.samples) else 8 * len(self.high)
        bits = np.unpackbits(self.high[begin // 8 : (end + 7) // 8], bitorder="little")
        bits[: begin % 8] = 0
        x = (np.flatnonzero(bits)[:n] + begin // 8 * 8 - np.arange(first, first + n)).astype(np.int64) << self.low_bits
        if self.low_bits:
            low = self.low[first * self.low_bits // 8 : ((first + n) * self.low_bits + 7) // 8]
            each = np.unpackbits(low, bitorder="little")[: n * self.low_bits].reshape(n, self.low_bits)
            x |= (each.astype(np.int64) << np.arange(self.low_bits)).sum(axis=1)
        return x + self.base

    def _low(self, i: int) -> int:
        first = i * self.low_bits
        raw = int.from_bytes(self.low[first // 8 : (first + self.low_bits + 7) // 8].tobytes(), "little")
        return raw >> first % 8 & (1 << self.low_bits) - 1

    def all(self) -> np.ndarray:
        """Every number in order."""
        return np.concatenate([np.zeros(0, np.int64), *(self.stretch(s) for s in range(len(self.samples)))])

    def to_bytes(self) -> bytes:
        head = _HEAD.pack(self.n, self.universe, self.base, self.low_bits)
        sizes = struct.pack("<QQQ", len(self.low), len(self.high), len(self.samples))
        return head + sizes + self.low.tobytes() + self.high.tobytes() + self.samples.tobytes()

    @classmethod
    def from_buffer(cls, data: memoryview, at: int = 0) -> tuple[EliasFano, int]:
        """The coded numbers that begin at ``at``, and where they end."""
        n, universe, base, bits = _HEAD.unpack_from(data, at)
        at += _HEAD.size
        low, high, samples = struct.unpack_from("<QQQ", data, at)
        at += 24
        a = np.frombuffer(data, np.uint8, low, at)
        b = np.frombuffer(data, np.uint8, high, at + low)
        c = np.frombuffer(data, np.uint32, samples, at + low + high)
        return cls(n, universe, base, bits, a, b, c), at + low + high + 4 * samples
