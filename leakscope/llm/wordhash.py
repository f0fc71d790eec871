"""Words and their 64-bit hashes for whole Arrow columns of texts, without a Python loop over words.

Texts are handled in blocks of about ``BLOCK`` bytes (a longer text is a block of its own),
so the memory of a task follows the block or the longest text, never the batch or the split.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

BLOCK = 1 << 20
BLOCK_ROWS = 1 << 12

#: Separators of the contracts: white space, or all ASCII but letters and digits.
SPACE = bytes([*range(0x09, 0x0E), 0x20])
NOT_ALNUM = bytes(c for c in range(0x80) if not chr(c).isalnum())

_U = np.uint64
with np.errstate(over="ignore"):
    _GOLDEN = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finalizer (splitmix64)."""
    x = (x ^ (x >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> _U(27))) * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def _odd(index: np.ndarray) -> np.ndarray:
    """Fixed odd multipliers for positions."""
    return mix((index.astype(_U) + _U(1)) * _GOLDEN) | _U(1)


_PLACES = _odd(np.arange(4096))


def _multipliers(places: np.ndarray) -> np.ndarray:
    if len(places) and int(places.max()) >= len(_PLACES):
        return _odd(places)
    return _PLACES[places]


def byte_table(separators: bytes, lower: bool = True) -> np.ndarray:
    """Byte to byte, A-Z lower-cased, separators 0. Bytes above 0x7F always belong to words, and U+0000 does if it is no
    separator: it becomes 0xFF, which UTF-8 never has."""
    table = np.arange(256, dtype=np.uint8)
    if lower:
        table[ord("A"):ord("Z") + 1] += 32
    table[0] = 0xFF
    table[list(separators)] = 0
    return table


@dataclass
class Words:
    """Words of the rows ``first .. first + n_rows - 1`` of a column, in text order."""

    first: int
    n_rows: int
    row: np.ndarray  # of each word, counted from 0 in this block
    hash: np.ndarray
    start: np.ndarray  # bytes, in ``data``
    end: np.ndarray
    counts: np.ndarray  # words of each row
    data: np.ndarray  # the block's bytes, lower-cased, separators 0

    @property
    def bounds(self) -> np.ndarray:
        """Index of each row's first word, and the end."""
        return np.concatenate(([0], np.cumsum(self.counts)))


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and offsets of a string column; null is empty."""
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    return (np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)), at.astype(np.int64)


def blocks(offsets: np.ndarray, limit: int = BLOCK) -> Iterator[tuple[int, int]]:
    """Row ranges of at most ``limit`` bytes and ``BLOCK_ROWS`` rows, or of one row."""
    row, n = 0, len(offsets) - 1
    while row < n:
        to = max(row + 1, int(np.searchsorted(offsets, offsets[row] + limit, "right")) - 1)
        to = min(to, row + BLOCK_ROWS, n)
        yield row, to
        row = to


def words(column: pa.Array, table: np.ndarray, limit: int = BLOCK) -> Iterator[Words]:
    """Words of every text of a column, block by block; rows without words have none."""
    data, offsets = text_buffers(column)
    for first, to in blocks(offsets, limit):
        begin = offsets[first]
        low = table[data[begin:offsets[to]]]
        yield block_words(low, offsets[first:to + 1] - begin, first)


def block_words(low: np.ndarray, offsets: np.ndarray, first: int = 0) -> Words:
    inside = low != 0
    n_rows = len(offsets) - 1
    if not inside.any():
        none = np.zeros(0, np.int64)
        return Words(first, n_rows, none, none.astype(_U), none, none, np.zeros(n_rows, np.int64), low)
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    edges = offsets[1:-1]
    edges = edges[(edges > 0) & (edges < len(low))]
    starts[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    row = np.searchsorted(offsets, start, "right") - 1
    place = np.arange(len(low)) - np.repeat(start, np.diff(np.append(start, len(low)))) if start[0] == 0 else \
        np.concatenate((np.zeros(start[0], np.int64),
                        np.arange(start[0], len(low)) - np.repeat(start, np.diff(np.append(start, len(low))))))
    # Separators are 0, so they add nothing wherever their places are.
    sums = np.add.reduceat(low.astype(_U) * _multipliers(place), start)
    value = mix(sums ^ ((end - start).astype(_U) * _GOLDEN))
    return Words(first, n_rows, row, value, start, end, np.bincount(row, minlength=n_rows), low)


def grams(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Index of the first word and hash of every k consecutive words of one row."""
    n = len(w.hash)
    if n < k:
        return np.zeros(0, np.int64), np.zeros(0, _U)
    at = np.flatnonzero(w.row[:n - k + 1] == w.row[k - 1:])
    multiplier = _odd(np.arange(k) + 7919)
    value = np.zeros(n - k + 1, _U)
    for j in range(k):
        value += w.hash[j:n - k + 1 + j] * multiplier[j]
    return at, mix(value[at] + _U(k))


def sequences(w: Words, rows: np.ndarray) -> np.ndarray:
    """Hash of the whole word sequence of each given row (none may be empty)."""
    bounds = w.bounds
    place = np.arange(len(w.hash)) - np.repeat(bounds[:-1], w.counts)
    multiplier = _odd(place + 7919)
    total = np.concatenate((np.zeros(1, _U), np.cumsum(w.hash * multiplier, dtype=_U)))
    return mix(total[bounds[rows + 1]] - total[bounds[rows]] + w.counts[rows].astype(_U))


def shingle_sets(w: Words, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct 52-bit shingle hashes of all rows, sorted within each row, and each row's bounds in them.

    A row with fewer than k words, but not none, has its whole sequence as its one shingle.
    """
    at, value = grams(w, k)
    row = w.row[at]
    short = np.flatnonzero((w.counts > 0) & (w.counts < k))
    if len(short):
        row, value = np.concatenate((row, short)), np.concatenate((value, sequences(w, short)))
    keys = np.sort((row.astype(_U) << _U(52)) | (value >> _U(12)))  # a block has at most 2**12 rows
    if len(keys):
        keys = keys[np.append(True, keys[1:] != keys[:-1])]
    bounds = np.searchsorted(keys, np.arange(w.n_rows, dtype=_U) << _U(52))
    return keys & _U((1 << 52) - 1), np.append(bounds, len(keys))
