"""Word, shingle and MinHash arithmetic over columns of UTF-8 text, vectorized with NumPy.

Texts are taken from Arrow buffers as they are and worked on in blocks of half a MB.
Hashes are polynomials modulo 2^64 over a fixed random table of byte values, divided
by the power of their start, so a string has the same hash wherever it stands.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE, WORD_BASE = 0x9E3779B97F4A7C15 | 1, 0xD6E8FEB86659FD93 | 1
_rng = np.random.default_rng(20240229)
BYTE_VALUE = _rng.integers(1, 2**63, 256, dtype="u8") * U(2) + U(1)
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
SENTENCE_END = np.zeros(256, bool)
SENTENCE_END[list(b".!?")] = True


def mixed(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the whole word."""
    h = h ^ (h >> U(33))
    h = h * U(0xFF51AFD7ED558CCD)
    h = h ^ (h >> U(29))
    h = h * U(0xC4CEB9FE1A85EC53)
    return h ^ (h >> U(32))


class Powers:
    """Powers of an odd base and of its inverse modulo 2^64, grown as needed."""

    def __init__(self, base: int):
        self.base, self.inverse = base, pow(base, -1, 2**64)
        self.up = self.down = np.ones(0, "u8")

    def __reduce__(self):
        return Powers, (self.base,)  # the tables are rebuilt where they are used

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 1 << 16)
            self.up, self.down = (self._table(b, size) for b in (self.base, self.inverse))
        return self.up[:n], self.down[:n]

    @staticmethod
    def _table(base: int, n: int) -> np.ndarray:
        out = np.full(n, base, "u8")
        out[0] = 1
        return np.multiply.accumulate(out)


BYTES, WORDS = Powers(BASE), Powers(WORD_BASE)


def prefix_hash(values: np.ndarray, powers: Powers) -> np.ndarray:
    """``p`` with ``p[j] - p[i]`` the unscaled hash of ``values[i:j]``."""
    up, _ = powers.get(len(values))
    out = np.zeros(len(values) + 1, "u8")
    np.cumsum(values * up, out=out[1:])
    return out


def range_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray, powers: Powers) -> np.ndarray:
    """Mixed hashes of the ranges ``[start, end)``; their lengths count."""
    _, down = powers.get(len(prefix))
    return mixed((prefix[end] - prefix[start]) * down[start] + (end - start).astype("u8"))


def text_blocks(column: pa.Array, limit: int = 1 << 19) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """``(first row, bytes, offsets)`` of runs of rows of about ``limit`` bytes; null counts as empty."""
    column = column.fill_null("") if column.null_count else column
    kind = "i8" if pa.types.is_large_string(column.type) else "i4"
    offsets = column.buffers()[1]
    offsets = np.zeros(1, kind) if offsets is None else np.frombuffer(offsets, kind)
    offsets = offsets[column.offset : column.offset + len(column) + 1].astype("i8")
    data = column.buffers()[2]
    data = np.frombuffer(data, "u1") if data is not None else np.zeros(0, "u1")
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        yield row, data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
        row = end


class Words:
    """The words of a block: runs of bytes other than space and ``\\t`` to ``\\r`` (or ``gaps``)."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE):
        n = len(data)
        inside = ~gaps[data]
        begin = inside.copy()
        begin[1:] &= ~inside[:-1]
        firsts = offsets[:-1][offsets[:-1] < n]
        begin[firsts] |= inside[firsts]  # a text's first word starts there whatever stands before
        self.start = np.flatnonzero(begin)
        stop = inside.copy()
        stop[:-1] &= ~inside[1:] | begin[1:]
        self.end = np.flatnonzero(stop) + 1
        self.prefix = prefix_hash(BYTE_VALUE[data], BYTES)
        self.hash = range_hash(self.prefix, self.start, self.end, BYTES)
        self.first = np.searchsorted(self.start, offsets[:-1])  # of each text
        self.last = np.append(self.first[1:], len(self.start))
        self.data = data

    def shingles(self, size: int, first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all runs of ``size`` words, by start; a segment of fewer words is one shingle.

        ``first`` and ``last`` bound the segments, which cover all words in order.
        Returned are the hashes and the segments' offsets into them.
        """
        n = last - first
        count = np.where(n > 0, np.maximum(n - size + 1, 1), 0)
        at = np.zeros(len(n) + 1, "i8")
        np.cumsum(count, out=at[1:])
        start = np.arange(at[-1]) - np.repeat(at[:-1] - first, count)
        end = np.minimum(start + size, np.repeat(last, count))
        prefix = prefix_hash(self.hash, WORDS)
        return range_hash(prefix, start, end, WORDS), at


def bands_for(threshold: float, rows: int, recall: float) -> int:
    """Bands of ``rows`` hashes that find a pair at ``threshold`` with probability ``recall``."""
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - threshold**rows)))


def band_keys(shingles: np.ndarray, at: np.ndarray, bands: int, rows: int, seed: int) -> np.ndarray:
    """(segments x bands) MinHash band keys; segments must not be empty."""
    rng = np.random.default_rng(seed)
    out = np.zeros((len(at) - 1, bands), "u8")
    if not len(out):
        return out
    low = (shingles >> U(32)).astype("u4")
    for b in range(bands):
        key = np.full(len(out), b + 1, "u8")
        for _ in range(rows):
            # Multiply-add-shift on 32 bits is enough for minima of sets far below 2^32.
            m, a = rng.integers(1, 2**32, 2, dtype="u4")
            x = low * (m | np.uint32(1)) + a
            x ^= x >> np.uint32(15)
            x *= np.uint32(0x2C1B3C6D)
            x ^= x >> np.uint32(13)
            key = mixed(key * U(BASE) + np.minimum.reduceat(x, at[:-1]))
        out[:, b] = key
    return out


def as_long(h: np.ndarray) -> np.ndarray:
    return h.view("i8")
