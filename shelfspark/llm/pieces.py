"""Whole texts cut where byte-level BPE always cuts, so that equal pieces are encoded once.

The tokenizers' split pattern never crosses from a non-blank character to the white space
after it, and what it does from such a place on depends on nothing before. So a text
cut before each blank or line feed that follows a non-blank gives pieces whose tokens, one after
the other, are the tokens of the whole text. Signs that follow a letter or digit at the end of a piece
are a token group of their own and are cut off too. A bounded table keeps pieces that were seen.
"""

from __future__ import annotations

import re
from collections.abc import Callable
from itertools import repeat

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space by Unicode's White_Space, as the split pattern's \\s has it.
_WHITE = "\t-\r \x85\xa0  -     　"
_RE2_WHITE = r"\t\n\x0b\x0c\r \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}"
_SEGMENT = re.compile(f"[{_WHITE}]*[^{_WHITE}]+|[{_WHITE}]+")

#: Signs that may be cut from the end of a piece, and what must stand before them: no mark that could join them.
_SIGNS = "!#$%&()*+,-./:;<=>?@[]^_`{|}~\"\\"
_SIGNED = r"[0-9A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{24F}]$"

#: Pieces kept by one Python worker; a full table is emptied and filled anew.
MOST_PIECES = 600_000


def _strings(some: pa.Array) -> list[str]:
    """As to_pylist, without a scalar for each value on the way."""
    return some.to_numpy(zero_copy_only=False).tolist()


class PieceTable:
    """Token ids of pieces; ``encode`` turns a list of new pieces into lists of ids."""

    def __init__(self, encode: Callable[[list[str]], list[list[int]]], most: int = MOST_PIECES):
        self.encode, self.most = encode, most
        self._clear()

    def _clear(self) -> None:
        self.index: dict[str, int] = {}
        self.starts, self.counts, self.flat = np.zeros(1024, np.int64), np.zeros(1024, np.int64), np.zeros(4096, np.uint32)
        self.used = 0

    def _rows(self, keys: list[str]) -> np.ndarray:
        rows = np.fromiter(map(self.index.get, keys, repeat(-1)), np.int64, len(keys))
        if (lost := np.flatnonzero(rows < 0)).size:
            new = list(dict.fromkeys(keys[i] for i in lost))
            ids = self.encode(new)
            n, counts = len(self.index), np.fromiter(map(len, ids), np.int64, len(ids))
            total = int(counts.sum())
            while n + len(new) > len(self.starts):
                self.starts, self.counts = (np.concatenate([x, np.zeros_like(x)]) for x in (self.starts, self.counts))
            while self.used + total > len(self.flat):
                self.flat = np.concatenate([self.flat, np.zeros_like(self.flat)])
            self.starts[n : n + len(new)] = self.used + np.cumsum(counts) - counts
            self.counts[n : n + len(new)] = counts
            self.flat[self.used : self.used + total] = np.fromiter((x for one in ids for x in one), np.uint32, total)
            self.used += total
            self.index.update(zip(new, range(n, n + len(new)), strict=True))
            rows[lost] = np.fromiter((self.index[keys[i]] for i in lost), np.int64, len(lost))
        return rows

    def _gather(self, offsets: np.ndarray, rows: np.ndarray) -> list[np.ndarray]:
        counts = self.counts[rows]
        ends = np.cumsum(counts)
        ids = self.flat[np.repeat(self.starts[rows] - (ends - counts), counts) + np.arange(ends[-1] if len(ends) else 0)]
        cuts = np.concatenate([[0], ends])[offsets]
        return [ids[a:b] for a, b in zip(cuts[:-1], cuts[1:], strict=True)]

    def _words(self, lists: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
        """Offsets and table rows of texts that were split at single blanks; each word gives a body and the signs behind it."""
        coded = lists.flatten().dictionary_encode()
        o = lists.offsets.to_numpy().astype(np.int64)
        o = o - o[0]
        words, codes = coded.dictionary, coded.indices.to_numpy()
        body = pc.ascii_rtrim(words, characters=_SIGNS)
        body = pc.if_else(pc.match_substring_regex(body, _SIGNED), body, words)
        cut = pc.binary_length(body).to_numpy(zero_copy_only=False)
        size = pc.binary_length(words).to_numpy(zero_copy_only=False)
        tails = np.full(len(words), -1, np.int64)
        if (some := np.flatnonzero(cut < size)).size:
            whole, short = _strings(words.take(pa.array(some))), _strings(body.take(pa.array(some)))
            tails[some] = self._rows([w[len(b) :] for w, b in zip(whole, short, strict=True)])
        # A blank stands before each word but the first of a text; a word after a line feed begins with that.
        blank = pc.binary_join_element_wise(" ", body, "")
        heads = self._rows(_strings(pc.if_else(pc.starts_with(body, "\n"), body, blank)))
        both = np.empty((len(codes), 2), np.int64)
        both[:, 0], both[:, 1] = heads[codes], tails[codes]
        first = codes[o[:-1]]
        both[o[:-1], 0] = self._rows(_strings(body.take(pa.array(first))))
        kept = both.ravel() >= 0
        return np.concatenate([[0], np.cumsum(kept)])[2 * o], both.ravel()[kept]

    def __call__(self, texts: pa.Array) -> list[np.ndarray]:
        """The ids of each text."""
        if len(self.index) > self.most:
            self._clear()
        if not len(texts):
            return []
        odd = pc.match_substring_regex(texts, f"[{_RE2_WHITE}][ \\n]").to_numpy(zero_copy_only=False)
        out: list = [None] * len(texts)
        if not odd.all():
            plain = texts.filter(pa.array(~odd)) if odd.any() else texts
            lists = pc.split_pattern(pc.replace_substring(plain, "\n", " \n"), " ")
            for i, ids in zip(np.flatnonzero(~odd), self._gather(*self._words(lists)), strict=True):
                out[i] = ids
        for i in np.flatnonzero(odd):
            keys = _SEGMENT.findall(texts[i].as_py())
            # Blanks inside a white run stay with the run: only a single blank before a word may start a piece.
            out[i] = self._gather(np.array([0, len(keys)]), self._rows(keys))[0]
        return out
