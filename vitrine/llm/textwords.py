"""Words and word n-grams of a block of texts as numpy arrays of 64-bit hashes.

Texts arrive as the bytes of an Arrow string column.  Words are maximal runs of
bytes other than space and 0x09-0x0D; a polynomial prefix sum over the block
gives every word's hash, and another over the word hashes every n-gram's, so no
Python object is made per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 32

_P, _Q = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
_powers: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def _power_table(base: np.uint64, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd base and of its inverse modulo 2^64."""
    have = _powers.get(int(base))
    if have is None or len(have[0]) < n:
        inverse = np.uint64(pow(int(base), -1, 1 << 64))
        n = max(n, 1 << 16)
        out = []
        for b in (base, inverse):
            x = np.full(n, b, np.uint64)
            x[0] = 1
            out.append(np.multiply.accumulate(x))
        _powers[int(base)] = have = tuple(out)
    return have


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all."""
    h = h ^ (h >> np.uint64(30))
    h *= np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    h ^= h >> np.uint64(31)
    return h


class Block:
    """The words of some texts: starts and ends (bytes in `data`), hashes, and `first`, the first word of each text."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool):
        n = len(data)
        self.data = data = LOWER[data] if lower else data
        self.offsets = offsets
        inside = ~SPACE[data]
        edge = np.zeros(n + 1, bool)
        edge[offsets] = True
        before = np.empty(n, bool)
        before[:1] = False
        before[1:] = inside[:-1]
        after = np.empty(n, bool)
        after[-1:] = False
        after[:-1] = inside[1:]
        self.starts = np.flatnonzero(inside & (~before | edge[:n]))
        self.ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.starts, offsets)

    def word_hashes(self) -> np.ndarray:
        n = len(self.data)
        power, inverse = _power_table(_P, n + 1)
        total = np.zeros(n + 1, np.uint64)
        np.cumsum((self.data.astype(np.uint64) + np.uint64(1)) * power[:n], out=total[1:])
        return mix((total[self.ends] - total[self.starts]) * inverse[self.starts] + (self.ends - self.starts).astype(np.uint64))

    def text_words(self, k: int) -> list[bytes]:
        raw = self.data.tobytes()
        a, b = self.first[k], self.first[k + 1]
        return [raw[s:e] for s, e in zip(self.starts[a:b].tolist(), self.ends[a:b].tolist())]


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of every run of n consecutive words: len(words) - n + 1 of them (none if shorter)."""
    if len(words) < n:
        return np.empty(0, np.uint64)
    power, inverse = _power_table(_Q, len(words) + 1)
    total = np.zeros(len(words) + 1, np.uint64)
    np.cumsum(words * power[: len(words)], out=total[1:])
    return mix((total[n:] - total[:-n]) * inverse[: len(words) - n + 1])


def blocks(texts: pa.Array, lower: bool, most: int = 2 << 20) -> Iterator[tuple[int, int, Block]]:
    """(from row, to row, Block) over a string column; null is the empty text.

    A block holds texts of at most `most` bytes together, or one longer text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    rows = len(texts)
    if not rows:
        return
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset: texts.offset + rows + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < rows:
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + most, "right")) - 1)
        own = offsets[at: to + 1]
        yield at, to, Block(data[own[0]: own[-1]], (own - own[0]).astype(np.int64), lower)
        at = to
