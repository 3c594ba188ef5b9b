"""Words of Arrow text batches as numpy arrays.

The bytes of a whole piece of a batch are classed by one table lookup, so that a word
costs no Python call. Word hashes are 64-bit polynomial hashes over prefix sums.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at a time; a longer row is a piece of its own.
PIECE_BYTES = 1 << 18

_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32

#: Words split at ASCII white space.
SPACED = np.ones(256, dtype=bool)
SPACED[[0x20, *range(0x09, 0x0E)]] = False
#: Words of ASCII digits, lower-case letters and all bytes beyond ASCII.
ALNUM = np.zeros(256, dtype=bool)
ALNUM[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_BYTE_CODES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)


class _Powers:
    """Powers of a base modulo 2**64, grown by doubling."""

    def __init__(self, base: int) -> None:
        self.base, self.table = base, np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> np.ndarray:
        while len(self.table) < n:
            step = np.uint64(pow(self.base, len(self.table), 1 << 64))
            self.table = np.concatenate([self.table, self.table * step])
        return self.table[:n]


_POWERS, _INVERSES = _Powers(_BASE), _Powers(_INVERSE)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of all rows in one array, and the offsets of the rows; null is empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(texts.buffers()[1], np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(texts.buffers()[2] or b"", np.uint8)[offsets[0] : offsets[-1]]
    return data, offsets - offsets[0]


def pieces(texts: pa.Array, limit: int = PIECE_BYTES) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes of text, or of one row."""
    _, offsets = text_bytes(texts)
    first, n = 0, len(offsets) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        yield first, last
        first = last


@dataclass
class Words:
    """``rows[i]:rows[i + 1]`` are the words of row i; spans are bytes of ``data``."""

    data: np.ndarray
    offsets: np.ndarray
    start: np.ndarray
    end: np.ndarray
    rows: np.ndarray
    hash: np.ndarray

    def row_of(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.rows) - 1), np.diff(self.rows))


def hash_spans(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of byte spans."""
    n = len(data)
    sums = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE_CODES[data] * _POWERS.upto(n), out=sums[1:])
    return mix((sums[end] - sums[start]) * _INVERSES.upto(n + 1)[start] + (end - start).astype(np.uint64))


def runs(data: np.ndarray, offsets: np.ndarray, word_byte: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end of the maximal runs of word bytes in each row, and their row offsets."""
    inside = np.zeros(len(data) + 2, dtype=bool)
    inside[1:-1] = word_byte[data]
    cut = np.zeros(len(data) + 1, dtype=bool)
    cut[offsets] = True
    start = np.flatnonzero(inside[1:] & (~inside[:-1] | cut))
    end = np.flatnonzero(inside[:-1] & (~inside[1:] | cut))
    return start, end, np.searchsorted(start, offsets)


def split_words(texts: pa.Array, word_byte: np.ndarray, lower: bool = True) -> Words:
    """Maximal runs of word bytes in each row; letters A-Z count as lower case."""
    raw, offsets = text_bytes(texts)
    data = _LOWER[raw] if lower else raw
    start, end, rows = runs(data, offsets, word_byte)
    return Words(data, offsets, start, end, rows, hash_spans(data, start, end))


def ngram_hashes(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the n-word shingles of every row, and their row offsets.

    A row of fewer words, but not none, has its whole sequence as one shingle.
    """
    h, counts = words.hash, np.diff(words.rows)
    made = np.where(counts >= n, counts - n + 1, (counts > 0).astype(np.int64))
    rows = np.concatenate([[0], np.cumsum(made)])
    row = np.repeat(np.arange(len(counts)), made)
    first = words.rows[:-1][row] + np.arange(rows[-1]) - rows[row]
    out = np.zeros(len(first), dtype=np.uint64)
    length = np.minimum(counts, n)[row]
    for k in range(n):
        on = length > k
        at = np.where(on, first + k, 0)
        out = np.where(on, mix(out * np.uint64(_BASE) + h[at] + np.uint64(k + 1)), out) if len(h) else out
    return out, rows
