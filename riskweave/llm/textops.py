"""Word positions and word hashes of many texts at once.

A batch of texts is one UTF-8 byte buffer with row offsets; words are the
maximal runs of bytes outside space, tab, LF, VT, FF and CR (none of these
bytes occurs inside a multi-byte UTF-8 character).  All functions work on the
whole buffer with array operations; :func:`chunks` bounds the buffer size, so
memory follows the chunk and not the batch.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 19

_SPACE = np.zeros(256, dtype=bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[0x41:0x5B] += 0x20

BASE = np.uint64(0x9E3779B97F4A7C15)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_BYTE = np.random.default_rng(20240131).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)


@dataclass
class Words:
    """Words of consecutive rows: ``data`` bytes, word ``start``/``end`` byte
    positions, ``first`` = index of each row's first word (one more entry than
    rows), ``row`` = row of each word."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    first: np.ndarray
    rows: int

    @property
    def count(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def row(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.count)


def _buffers(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and row offsets of a string column; a null text is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = texts.cast(pa.large_string()).fill_null("")
    _, offsets, data = texts.buffers()
    off = np.frombuffer(offsets, dtype=np.int64)[texts.offset:texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw, off


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, last row + 1, bytes, offsets) of consecutive rows that hold
    about ``limit`` bytes (one longer text makes a chunk of its own)."""
    if len(texts) == 0:
        return
    raw, off = _buffers(texts)
    lo, n = 0, len(off) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(off, off[lo] + limit, side="right")) - 1)
        hi = min(hi, n)
        yield lo, hi, raw[off[lo]:off[hi]], off[lo:hi + 1] - off[lo]
        lo = hi


def words(data: np.ndarray, off: np.ndarray) -> Words:
    n = len(data)
    word = ~_SPACE[data]
    before = np.zeros(n + 1, dtype=bool)
    before[1:] = word
    before[off[:-1]] = False
    after = np.zeros(n + 1, dtype=bool)
    after[:n] = word
    after[off] = False
    start = np.flatnonzero(word & ~before[:n])
    end = np.flatnonzero(word & ~after[1:]) + 1
    return Words(data, start, end, np.searchsorted(start, off), len(off) - 1)


def mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(33))
    x = x * np.uint64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> np.uint64(29))
    x = x * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(32))


def word_hashes(w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of every word's bytes: a polynomial in an odd base, summed
    once over the buffer and shifted back to each word's start."""
    if len(w.start) == 0:
        return np.zeros(0, np.uint64)
    data = LOWER[w.data] if lower else w.data
    n = len(data)
    power = np.full(n, BASE, np.uint64)
    power[0] = 1
    np.cumprod(power, out=power)
    total = np.zeros(n + 1, np.uint64)
    np.cumsum(_BYTE[data] * power, out=total[1:])
    back = np.full(n, _BASE_INV, np.uint64)
    back[0] = 1
    np.cumprod(back, out=back)
    return mix((total[w.end] - total[w.start]) * back[w.start])


def kmer_hashes(w: Words, h: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all ``k``-word runs within a row, and the word index of each."""
    n = len(h) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    acc = np.zeros(n, np.uint64)
    for j in range(k):
        acc = acc * BASE + h[j:j + n]
    row = w.row
    at = np.flatnonzero(row[:n] == row[k - 1:])
    return mix(acc[at]), at
