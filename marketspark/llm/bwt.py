"""Burrows-Wheeler transforms of many short strings, and their merge by refining an interleave.

Strings are arrays of bytes that end with STOP, a byte that UTF-8 never has; every position stands
for the rotation of its string that begins there. Orders go by the first DEPTH bytes.
"""

from __future__ import annotations

import numpy as np

DEPTH = 50
STOP = 255
#: Bytes that one step of the refinement goes back at most; the first step takes what is left over.
STRIDE = 6
#: Bits of a rank or a place in a shard; three fit in a 64-bit number.
BITS = 21
LOW = np.uint64((1 << BITS) - 1)
SHIFT = np.uint64(BITS)


class Shard:
    """The order of a shard's rotations by DEPTH bytes, and the STRIDE bytes before each, in that order."""

    def __init__(self, data: np.ndarray, starts: np.ndarray):
        """``data``: strings one after the other, each ended by STOP; ``starts``: where they begin."""
        if len(data) > int(LOW):
            raise ValueError("a shard holds less than 2**21 bytes")
        self.data, self.starts = data, starts
        lengths = np.diff(np.append(starts, len(data)))
        own = np.repeat(np.arange(len(starts)), lengths)
        self.string = own
        self.offset = np.arange(len(data)) - starts[own]
        self.length = lengths[own]
        self.order = self._sorted()
        before = np.zeros(len(data), np.uint64)
        for k in range(STRIDE, 0, -1):
            before = before << np.uint64(8) | data[self._moved(-k)]
        #: The bytes before, the nearest in the low byte.
        self.before = before[self.order]

    def _moved(self, by: int) -> np.ndarray:
        at = self.offset + by
        out = at < 0 if by < 0 else at >= self.length
        place = np.arange(by, by + len(at))
        place[out] += at[out] % self.length[out] - at[out]
        return place

    def _sorted(self) -> np.ndarray:
        """Prefix doubling: order by 5 bytes, then by 10, 20, 40 and 50 from pairs of ranks.

        The place is the low part of the number that is sorted, so no index sort is needed.
        """
        key = np.zeros(len(self.data), np.uint64)
        for k in range(5):
            key = key << np.uint64(8) | self.data[self._moved(k)]
        place = np.arange(len(self.data), dtype=np.uint64)
        for reach, to in ((0, 5), (5, 10), (10, 20), (20, 40), (40, DEPTH)):
            if reach:
                key = rank << SHIFT | rank[self._moved(to - reach)]
            line = np.sort(key << SHIFT | place)
            order = (line & LOW).astype(np.int64)
            line >>= SHIFT
            rank = np.empty(len(key), np.uint64)
            rank[order] = np.cumsum(np.concatenate(([False], line[1:] != line[:-1])))
        return order


def _by_shard(shard: np.ndarray, shards: int) -> np.ndarray:
    """Places in the interleave, those of the first shard first."""
    if shards > 8:
        return np.argsort(shard, kind="stable")
    return np.concatenate([np.flatnonzero(shard == s) for s in range(shards)])


def merged(befores: list[np.ndarray], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray]:
    """Interleave of the shards' orders by ``depth`` bytes, and where a new prefix begins.

    The interleave starts with the shards one after the other. A step reads every shard's
    preceding bytes in the present interleave and deals the shard numbers into stable buckets
    by those bytes: what was in the order of k bytes is then in the order of k + s, for a step
    of s bytes. Two neighbours have a common prefix of k + s bytes if their bytes are the same and
    the places they come from were in one block of common prefixes of k bytes. No suffix is looked
    at. Bytes and place are sorted as one 64-bit number, so a step has as many bytes as places leave
    room for.
    """
    count = sum(len(b) for b in befores)
    stride = min(STRIDE, max(1, (64 - count.bit_length()) // 8))
    room = np.uint64(64 - 8 * stride)
    low = (np.uint64(1) << room) - np.uint64(1)
    flat = np.concatenate(befores)
    shard = np.repeat(np.arange(len(befores), dtype=np.uint16), [len(b) for b in befores])
    opens = np.zeros(count, bool)
    opens[:1] = True
    place = np.arange(count, dtype=np.uint64)
    symbol = np.empty(count, np.uint64)
    left = depth
    while left:
        back = left % stride or stride
        left -= back
        symbol[_by_shard(shard, len(befores))] = flat & np.uint64((1 << 8 * back) - 1)
        line = np.sort(symbol << room | place)
        dealt = (line & low).astype(np.int64)
        line >>= room
        block = np.cumsum(opens, dtype=np.int32)[dealt]
        shard = shard[dealt]
        opens[1:] = (line[1:] != line[:-1]) | (block[1:] != block[:-1])
    return shard, opens


def common_prefixes(shards: list[Shard], depth: int = DEPTH) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For all rotations in merged order: their shard, their place in it, and the number of their block.

    Rotations in one block have the first ``depth`` bytes in common.
    """
    shard, opens = merged([s.before for s in shards], depth)
    place = np.empty(len(shard), np.int64)
    place[_by_shard(shard, len(shards))] = np.concatenate([s.order for s in shards])
    return shard, place, np.cumsum(opens) - 1
