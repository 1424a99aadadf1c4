"""Hashes of words and word windows for many texts at once, in numpy."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U = np.uint64
BASE = 0x9E3779B97F4A7C15
MIX_A, MIX_B = U(0xBF58476D1CE4E5B9), U(0x94D049BB133111EB)
STEP = U(0x2545F4914F6CDD1D)
#: Bytes of text that are worked on at a time; one longer text is worked on alone.
CHUNK = 1 << 17

_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]
_lower = np.arange(256, dtype=np.uint64)
_lower[65:91] += U(32)
_blank = np.zeros(256, bool)
_blank[[0x20, *range(0x09, 0x0E)]] = True


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse modulo 2**64; tables grow as needed."""
    if len(_powers[0]) <= n:
        size = max(n + 1, 2 * len(_powers[0]))
        for at, base in enumerate((BASE, pow(BASE, -1, 1 << 64))):
            table = np.full(size, U(base))
            table[0] = 1
            _powers[at] = np.cumprod(table)
    return _powers[0], _powers[1]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values, one to one."""
    x = (x ^ (x >> U(30))) * MIX_A
    x = (x ^ (x >> U(27))) * MIX_B
    return x ^ (x >> U(31))


def texts(column: pa.Array) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Runs of texts of about CHUNK bytes: first row, end row, their bytes, and offsets of each text.

    Null texts are empty. ``column`` is a string or large string array.
    """
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    offsets = np.frombuffer(column.buffers()[1], np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1].astype(np.int64)
    data = column.buffers()[2]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + CHUNK, side="right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first]:offsets[end]], offsets[first:end + 1] - offsets[first]
        first = end


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of every word of the texts in ``data``, and the first word of each text (one more at the end).

    Words are runs of other bytes than ASCII blanks, A to Z lower-cased; none spans two texts.
    Equal words have equal hashes; different ones differ but for a chance of about 2**-64.
    """
    if not len(data):
        return np.empty(0, np.uint64), np.zeros(len(offsets), np.int64)
    inside = ~_blank[data]
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    starts[bounds] = inside[bounds]
    ends[bounds - 1] = inside[bounds - 1]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    power, inverse = powers(len(data))
    sums = np.empty(len(data) + 1, np.uint64)
    sums[0] = 0
    np.cumsum((_lower + U(1))[data] * power[:len(data)], out=sums[1:])
    hashes = mix((sums[to] - sums[at]) * inverse[at] + (to - at).astype(np.uint64) * STEP)
    return hashes, np.searchsorted(at, offsets)


def joined(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of every window of ``n`` consecutive hashes."""
    size = max(0, len(hashes) - n + 1)
    total = np.zeros(size, np.uint64)
    for k in range(n):
        total = (total + hashes[k:k + size]) * STEP + U(k + 1)
    return mix(total)


def shingle_sets(column: pa.Array, n: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """First row and sorted distinct shingle hashes of each text, for run after run of texts.

    A text of fewer than ``n`` words, but one at least, has all its words as its one shingle.
    """
    none = np.empty(0, np.uint64)
    for first, end, data, offsets in texts(column):
        hashes, at = words(data, offsets)
        windows = joined(hashes, n)
        sets = []
        for i in range(end - first):
            a, b = at[i], at[i + 1]
            if b - a >= n:
                own = np.sort(windows[a:b - n + 1])
                sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
            else:
                sets.append(joined(hashes[a:b], int(b - a)) if b > a else none)
        yield first, sets
