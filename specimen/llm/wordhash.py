"""Hashes of all words of many texts at once, from the bytes of an Arrow column.

Words are ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased.  A word's hash is taken over
its 8-byte pieces, each mixed with its number; no word becomes a Python object and
nothing is kept between blocks, so memory is bounded by a block's bytes.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

BLOCK_BYTES = 400_000
_U = np.uint64
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
_LOWER = np.arange(256, dtype=np.uint8) + np.where((np.arange(256) >= 65) & (np.arange(256) <= 90), 32, 0).astype(np.uint8)
_KEEP = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def byte_blocks(column: pa.Array, limit: int | None = None):
    """(first row, offsets, bytes) of a string column, some ``limit`` bytes at a time and
    at least one row; a null is an empty text."""
    limit = limit or BLOCK_BYTES
    column = column.cast(pa.binary())
    if column.null_count:
        column = column.fill_null(b"")
    n = len(column)
    if not n:
        return
    _, ends, data = column.buffers()
    ends = np.frombuffer(ends, np.int32)[column.offset:column.offset + n + 1].astype(np.int64)
    data = np.frombuffer(data or b"", np.uint8)
    first = 0
    while first < n:
        upto = max(first + 1, int(np.searchsorted(ends, ends[first] + limit, "right")) - 1)
        yield first, ends[first:upto + 1] - ends[first], data[ends[first]:ends[upto]]
        first = upto


def word_hashes(offsets: np.ndarray, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(hashes, words of each text) of texts that lie in ``data`` between ``offsets``."""
    n = len(data)
    inside = ~_SPACE[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    heads, tails = offsets[:-1][offsets[:-1] < n], offsets[1:][offsets[1:] > 0] - 1
    opens[heads] = inside[heads]
    closes[tails] = inside[tails]
    start, stop = np.flatnonzero(opens), np.flatnonzero(closes) + 1
    lengths = np.diff(np.searchsorted(start, offsets))
    if not len(start):
        return np.zeros(0, np.uint64), lengths
    padded = np.zeros(n + 8, np.uint8)
    padded[:n] = _LOWER[data]
    eight = np.ndarray(n + 1, "<u8", padded, strides=(1,))
    pieces = (stop - start + 7) >> 3
    upto = np.cumsum(pieces)
    number = np.arange(upto[-1]) - np.repeat(upto - pieces, pieces)
    at = np.repeat(start, pieces) + 8 * number
    value = eight[at] & _KEEP[np.minimum(np.repeat(stop, pieces) - at, 8)]
    value = mix(value + (number + 1).astype(np.uint64) * _U(0x9E3779B97F4A7C15))
    return mix(np.add.reduceat(value, upto - pieces) + (stop - start).astype(np.uint64)), lengths


def sorted_within(group: np.ndarray, value: np.ndarray) -> np.ndarray:
    """The order by ``group``, small numbers, and ``value``."""
    order = np.argsort(value)
    small = group[order].astype(np.uint16 if int(group.max(initial=0)) < 1 << 16 else np.uint32)
    return order[np.argsort(small, kind="stable")]
