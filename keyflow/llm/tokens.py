"""Words of many texts at once, as hashes, straight from Arrow's text bytes.

A Karp-Rabin hash is a polynomial over bytes (or over word hashes), so running
sums give the hash of every word (or run of words) with a few vector
operations and no Python object per word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: bytes of text handled at a time (or one longer text)
CHUNK_BYTES = 2_000_000

_U = np.uint64
_BASE, _INVERSE = _U(0x9E3779B97F4A7C15), _U(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
_powers = np.ones(1, _U)
_inverses = np.ones(1, _U)

#: byte tables: the word characters of each kind of word; lower case of A-Z
IS_SPACE_WORD = np.ones(256, bool)
IS_SPACE_WORD[[0x20, *range(0x09, 0x0E)]] = False
IS_LETTER_WORD = np.zeros(256, bool)
IS_LETTER_WORD[[*range(0x30, 0x3A), *range(0x41, 0x5B), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True
SAME = np.arange(256, dtype=np.uint8)
LOWER = SAME.copy()
LOWER[0x41:0x5B] += 32


def _grow(n: int) -> None:
    global _powers, _inverses
    if len(_powers) <= n:
        size = 1 << int(n).bit_length()
        with np.errstate(over="ignore"):
            _powers = np.concatenate(([_U(1)], np.cumprod(np.full(size, _BASE))))
            _inverses = np.concatenate(([_U(1)], np.cumprod(np.full(size, _INVERSE))))


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit words that spreads every bit over all others."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


class Words:
    """``hash`` of every word, and ``first[i]:first[i + 1]`` the words of text ``i``; byte places of the words."""

    __slots__ = ("hash", "first", "start", "end", "data")

    def __init__(self, data: np.ndarray, edges: np.ndarray, is_word: np.ndarray, lower: np.ndarray):
        """``data``: the texts' bytes one after the other; ``edges``: where each begins, and the end."""
        n = len(data)
        inside = np.zeros(n + 2, bool)
        inside[1:-1] = is_word[data]
        begin = inside[1:-1] & ~inside[:-2]
        stop = inside[1:-1] & ~inside[2:]
        inner = edges[(edges > 0) & (edges < n)]
        begin[inner] = inside[inner + 1]
        stop[inner - 1] = inside[inner]
        self.data = data
        self.start, self.end = np.flatnonzero(begin), np.flatnonzero(stop) + 1
        self.hash = runs(lower[data].astype(_U) + _U(1), self.start, self.end)
        self.first = np.searchsorted(self.start, edges)

    def __len__(self) -> int:
        return len(self.first) - 1

    def text_of(self) -> np.ndarray:
        """The text each word belongs to."""
        return np.repeat(np.arange(len(self)), np.diff(self.first))


def runs(values: np.ndarray, start: np.ndarray, end: np.ndarray, seed: int = 0) -> np.ndarray:
    """Hash of ``values[start:end]`` for every pair of places."""
    _grow(len(values))
    sums = np.empty(len(values) + 1, _U)
    sums[0] = 0
    np.cumsum(values * _powers[:len(values)], out=sums[1:])
    h = (sums[end] - sums[start]) * _inverses[start]
    return mix(h + (end - start).astype(_U) * _U(0xD6E8FEB86659FD93) + _U(seed))


def windows(values: np.ndarray, first: np.ndarray, size: int, seed: int = 0) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of every run of ``size`` values that lies within one text."""
    if len(values) < size:
        return np.empty(0, _U), np.empty(0, np.int64)
    ok = np.ones(len(values) - size + 1, bool)
    ends = first[1:-1]
    for k in range(1, size):  # windows that would cross into the next text
        at = ends - k
        ok[at[(at >= 0) & (at < len(ok))]] = False
    at = np.flatnonzero(ok)
    return runs(values, at, at + size, seed), at


def parts(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Slices ``from, to`` of a text column, their bytes and the texts' edges in them (null: empty)."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + len(column) + 1]
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    at = 0
    while at < len(column):
        to = max(at + 1, int(np.searchsorted(offsets, offsets[at] + limit, "right")) - 1)
        to = min(to, len(column))
        yield at, to, data[offsets[at]:offsets[to]], offsets[at:to + 1] - offsets[at]
        at = to


def words_of(column: pa.Array, is_word: np.ndarray = IS_SPACE_WORD, lower: np.ndarray = SAME,
             limit: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Words]]:
    for at, to, data, edges in parts(column, limit):
        yield at, to, Words(data, edges, is_word, lower)
