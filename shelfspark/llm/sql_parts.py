"""Pieces of DuckDB SQL that several twins share."""

from __future__ import annotations

import zlib

#: The 256 steps of CRC-32, each from the checksum of its byte.
_STEPS = [zlib.crc32(bytes([i])) ^ zlib.crc32(b"\0") for i in range(256)]
_FULL = "4294967295::BIGINT"


def crc32(text: str) -> str:
    """The unsigned CRC-32 of an ASCII text expression, null for null."""
    steps = "[" + ",".join(str(s) for s in _STEPS) + "]::BIGINT[]"
    codes = f"list_transform(string_split({text}, ''), lambda x: ascii(x)::BIGINT)"
    return f"if({text} IS NULL, NULL, xor(list_reduce(list_prepend({_FULL}, {codes}), lambda c, b: xor(c >> 8, ({steps})[(xor(c, b) & 255) + 1])), {_FULL}))"
