"""Remove passages that an earlier document has: merged Burrows-Wheeler transforms of what recurs.

Every window of DEPTH bytes belongs to its least 16-byte string by hash, its anchor, so equal
windows have equal anchors wherever they are. Windows in a row with one anchor are a stretch of at
most 84 bytes. Only stretches whose anchor another document has are brought together, by anchor;
there their transforms are merged and equal windows found. Of an anchor with very many stretches
every window is a stretch of its own, brought together by the hash of its bytes.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.llm.bwt import DEPTH, STOP, Shard, common_prefixes
from marketspark.llm.common import give_back, kept, tidy
from marketspark.llm.hashing import U, mix, powers, texts

ANCHOR = 16
WINDOWS = DEPTH - ANCHOR + 1
#: Bytes of text in a group of documents, and in what is brought together by anchor.
GROUP = 8 << 20
#: Bytes of stretches that are merged together where their anchors allow it, and bytes of a shard.
BATCH = 48 << 10
SHARD = 1 << 15
SHARDS = 60_000
#: Bytes of strings among which windows that recur are looked for.
FILTERED = 1 << 17
#: Bytes of strings that are copied at a time: each byte's place takes 8 bytes more than once.
COPIED = 1 << 17
#: Anchors after which a task hands them on.
FLUSH = 1_000_000
#: Stretches of an anchor from which on its windows go one by one; below 2**16, where counts end.
HOT = 1 << 15
PLACE = U((1 << 28) - 1)
NONE = np.int64(-1 << 63)


def _eights(data: np.ndarray) -> np.ndarray:
    return np.ndarray((len(data) - 7,), "<u8", data.tobytes(), strides=(1,)).astype(np.uint64)


def stretches(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Text number, start, number of windows and anchor hash of every stretch of the texts in ``data``."""
    none = np.empty(0, np.int64)
    if len(data) < DEPTH:
        return none, none, none, np.empty(0, np.uint64)
    eight = _eights(data)
    hashes = mix(eight[:-8] * U(0x9E3779B97F4A7C15) ^ mix(eight[8:]))
    least = (hashes & ~PLACE) | np.arange(len(hashes), dtype=np.uint64)
    width = 1
    while 2 * width <= WINDOWS:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    if width < WINDOWS:
        least = np.minimum(least[:width - WINDOWS], least[WINDOWS - width:])
    inside = np.zeros(len(data) + 1, np.int32)
    long_enough = np.diff(offsets) >= DEPTH
    inside[offsets[:-1][long_enough]] = 1
    np.add.at(inside, offsets[1:][long_enough] - DEPTH + 1, -1)
    at = np.flatnonzero(np.cumsum(inside[:len(least)]))
    anchor = (least[at] & PLACE).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], anchor[1:] != anchor[:-1]))) if len(at) else none
    count = np.diff(np.append(first, len(at)))
    start = at[first]
    return np.searchsorted(offsets, start, side="right") - 1, start, count, hashes[anchor[first]]


def contents(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Hash of each of the byte strings ``data[start:start + size]``."""
    power, inverse = powers(len(data))
    sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum((data.astype(np.uint64) + U(1)) * power[:len(data)])))
    return mix((sums[start + size] - sums[start]) * inverse[start] + size.astype(np.uint64) * U(0x2545F4914F6CDD1D))


def keys(anchors: np.ndarray, buckets: int) -> np.ndarray:
    """Bucket in the high half, 32 bits of the anchor in the low half."""
    return ((anchors >> U(32)) % U(buckets)) << U(32) | anchors & U(0xFFFFFFFF)


def _among(wanted: np.ndarray, key: np.ndarray) -> np.ndarray:
    """Whether each key is in the sorted array ``wanted``."""
    if not len(wanted):
        return np.zeros(len(key), bool)
    return wanted[np.minimum(np.searchsorted(wanted, key), len(wanted) - 1)] == key


def divided(data, text, start, count, key, buckets: int, hot: np.ndarray):
    """The stretches, those of a key in ``hot`` cut into single windows with a key of their bytes.

    Equal windows have one anchor, so they are cut everywhere or nowhere, and their new keys are equal.
    """
    cut = _among(hot, key)
    if not cut.any():
        return text, start, count, key
    n = np.where(cut, count, 1)
    of = np.repeat(np.arange(len(n)), n)
    start = start[of] + np.arange(len(of)) - np.repeat(np.cumsum(n) - n, n)
    text, count, key, cut = text[of], np.where(cut, 1, count)[of], key[of], cut[of]
    key[cut] = keys(contents(data, start[cut], np.full(int(cut.sum()), DEPTH)), buckets)
    return text, start, count, key


def _long_texts(column: pa.Array):
    for first, end, data, offsets in texts(column):
        if len(data) > int(PLACE):
            raise ValueError("a text is longer than 256 MB")
        yield first, end, data, offsets


def _anchor_task(buckets: int):
    """Anchors of a task's documents by bucket: at most two for each anchor and group of documents.

    The first of them has the number of their stretches, 65,535 at most.
    """
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0

        def flush():
            key, group, doc = (np.concatenate(c) for c in zip(*found, strict=True))
            found.clear()
            order = np.lexsort((doc, group, key))
            key = key[order]
            group = group[order]
            doc = doc[order]
            same = np.concatenate(([False], (key[1:] == key[:-1]) & (group[1:] == group[:-1])))
            first = np.flatnonzero(~same)
            count = np.zeros(len(key), np.uint16)
            count[first] = np.minimum(np.diff(np.append(first, len(key))), 0xFFFF)
            keep = ~same | np.concatenate(([True], doc[1:] != doc[:-1]))
            key, group, count = key[keep], group[keep], count[keep]
            third = np.zeros(len(key), bool)
            third[2:] = (key[2:] == key[:-2]) & (group[2:] == group[:-2])
            key, group, count = key[~third], group[~third], count[~third]
            bucket = (key >> U(32)).astype(np.int64)
            ends = np.flatnonzero(np.concatenate((bucket[1:] != bucket[:-1], [True]))) + 1
            begin = 0
            rows = []
            for end in ends:
                rows.append((int(bucket[begin]), key[begin:end].astype(np.uint32).tobytes(), group[begin:end].astype(np.uint32).tobytes(), count[begin:end].tobytes()))
                begin = end
            return pa.record_batch([pa.array(c) for c in zip(*rows, strict=True)], ["bucket", "anchors", "groups", "counts"])

        number = 0
        for batch in batches:
            groups = batch.column("g").to_numpy()
            for first, end, data, offsets in _long_texts(batch.column("text")):
                text, _, _, anchors = stretches(data, offsets)
                if len(text):
                    found.append((keys(anchors, buckets), groups[first + text].astype(np.uint32), (number + first + text).astype(np.uint32)))
                    held += len(text)
                if held >= FLUSH:
                    yield flush()
                    held = 0
            number += batch.num_rows
        if held:
            yield flush()

    return task


def _shared_anchors(hot: int):
    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        """Of one bucket, for each group of documents the anchors that some other document has too.

        Group -1 has those with ``hot`` stretches or more.
        """
        anchors, groups, counts = (np.concatenate([np.frombuffer(x, t) for x in rows[c]]) for c, t in (("anchors", np.uint32), ("groups", np.uint32), ("counts", np.uint16)))
        order = np.argsort(anchors, kind="stable")
        of = anchors[order]
        same = of[1:] == of[:-1]
        twice = order[np.concatenate((same, [False])) | np.concatenate(([False], same))]
        pairs = np.unique(groups[twice].astype(np.uint64) << U(32) | anchors[twice])
        group = (pairs >> U(32)).astype(np.int64)
        cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.zeros(1, np.int64)
        first = np.flatnonzero(np.concatenate(([True], ~same)))
        many = of[first][np.add.reduceat(counts[order].astype(np.int64), first) >= hot]
        return pd.DataFrame({
            "g": pd.Series([-1] * bool(len(many)) + [int(group[a]) for a in cuts[:-1]], dtype="int64"), "bucket": int(key[0]),
            "anchors": [many.tobytes()] * bool(len(many)) + [pairs[a:b].astype(np.uint32).tobytes() for a, b in zip(cuts[:-1], cuts[1:], strict=True)],
        })

    return task


def _keys_of(rows) -> np.ndarray:
    """The sorted keys of (bucket, anchors) pairs."""
    found = [np.frombuffer(a, np.uint32).astype(np.uint64) | U(b) << U(32) for b, a in rows]
    return np.sort(np.concatenate(found)) if found else np.empty(0, np.uint64)


def _ids(column: pa.Array) -> np.ndarray:
    return column.fill_null(0).to_numpy()


def _runs(table: pa.Table):
    """Ids, whether they are there, and runs of texts of a group of documents."""
    for batch in table.combine_chunks().to_batches():
        ids = batch.column("doc_id")
        known = ids.is_valid().to_numpy(zero_copy_only=False)
        for first, end, data, offsets in _long_texts(batch.column("text")):
            yield batch, first, end, _ids(ids)[first:end], known[first:end], data, offsets


def _stretch_task(buckets: int, hot: np.ndarray):
    """Distinct stretches of a group of documents whose anchors are shared, by bucket of the anchor."""
    def task(docs: pa.Table, shared: pa.Table) -> pa.Table:
        wanted = _keys_of(zip(shared.column("bucket").to_pylist(), shared.column("anchors").to_pylist(), strict=True))
        rows = []
        if len(wanted) and docs.num_rows:
            parts = []
            for _, _, _, ids, known, data, offsets in _runs(docs):
                text, start, count, anchors = stretches(data, offsets)
                key = keys(anchors, buckets)
                take = _among(wanted, key) & known[text]
                text, start, count, key = divided(data, text[take], start[take], count[take], key[take], buckets, hot)
                size = count + DEPTH - 1
                if len(text):
                    parts.append(_distinct(contents(data, start, size), _bins(key), ids[text], size, _cut(data, start, size)))
            if parts:
                rows = _packed(*_distinct(*_joined(parts)))
        return pa.table([pa.array(c, t) for c, t in zip(zip(*rows, strict=True) if rows else [[]] * 7, STRETCH_TYPES, strict=True)], STRETCH_NAMES)

    return task


STRETCH_NAMES = ["bucket", "parts", "hashes", "docs", "multi", "sizes", "body"]
STRETCH_TYPES = [pa.int64(), *[pa.binary()] * 6]


def _bins(key: np.ndarray) -> np.ndarray:
    """Bucket, and in the low byte one of its 256 parts, of each anchor's key."""
    return (key >> U(32) << U(8) | key & U(0xFF)).astype(np.int64)


def _cut(data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The strings ``data[start:start + size]`` one after the other."""
    ends = np.cumsum(size)
    out = np.empty(ends[-1] if len(ends) else 0, data.dtype)
    moved, first, done = start - (ends - size), 0, 0
    while done < len(out):
        last = max(first + 1, int(np.searchsorted(ends, done + COPIED, side="right")))
        end = int(ends[last - 1])
        out[done:end] = data[np.arange(done, end) + np.repeat(moved[first:last], size[first:last])]
        first, done = last, end
    return out


def _joined(parts):
    hashes, bucket, docs, multi, sizes, body = zip(*parts, strict=True)
    return np.concatenate(hashes), np.concatenate(bucket), np.concatenate(docs), np.concatenate(sizes), np.concatenate(body), np.concatenate(multi)


def _firsts(hashes, docs, multi=None):
    """A place of each different string, its hash, least doc, and whether several docs have it."""
    order = np.lexsort((docs, hashes))
    of = hashes[order]
    first = np.flatnonzero(np.concatenate(([True], of[1:] != of[:-1])))
    least, most = docs[order][first], np.maximum.reduceat(docs[order], first)
    several = least != most
    if multi is not None:
        several |= np.logical_or.reduceat(multi[order], first)
    return order[first], of[first], least, several


def _distinct(hashes, bucket, docs, sizes, body, multi=None):
    """Each string once: hash, bucket and part, least doc, whether several docs have it, size, and bytes."""
    at, marks, least, several = _firsts(hashes, docs, multi)
    starts = np.cumsum(sizes) - sizes
    return marks, bucket[at], least, several, sizes[at], _cut(body, starts[at], sizes[at])


def _packed(hashes, bucket, docs, multi, sizes, body):
    order = np.argsort(bucket, kind="stable")
    starts = (np.cumsum(sizes) - sizes)[order]
    hashes, part, docs, multi, sizes = hashes[order], bucket[order], docs[order], multi[order], sizes[order]
    bucket = part >> 8
    cuts = np.flatnonzero(np.concatenate(([True], bucket[1:] != bucket[:-1], [True])))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield (
            int(bucket[a]), part[a:b].astype(np.uint8).tobytes(), hashes[a:b].tobytes(), docs[a:b].astype(np.int64).tobytes(), multi[a:b].astype(np.uint8).tobytes(),
            sizes[a:b].astype(np.uint8).tobytes(), _cut(body, starts[a:b], sizes[a:b]).tobytes(),
        )


def first_documents(docs: np.ndarray, multi: np.ndarray, sizes: np.ndarray, body: np.ndarray) -> np.ndarray:
    """For every byte of the strings the least doc that has the window beginning there; NONE if only one has.

    The strings are dealt over shards, each shard's transform is made, and the transforms are merged.
    """
    total = int(sizes.sum())
    parts = max(min(2, len(sizes)), min(SHARDS, -(-total // SHARD)))
    starts = np.cumsum(sizes) - sizes
    cut = np.searchsorted(starts, np.arange(parts) * (total / parts))
    shards, strings = [], []
    for a, b in zip(cut, np.append(cut[1:], len(sizes)), strict=True):
        if a == b:
            continue
        own, size = np.arange(a, b), sizes[a:b] + 1
        begins = np.cumsum(size) - size
        data = np.full(int(size.sum()), STOP, np.uint8)
        within = np.arange(int(sizes[a:b].sum())) + np.repeat(np.arange(b - a), sizes[a:b])
        data[within] = body[starts[a]:starts[a] + int(sizes[a:b].sum())]
        shards.append(Shard(data, begins))
        strings.append(own)
    which, place, block = common_prefixes(shards)
    string = np.concatenate([own[shard.string] for shard, own in zip(shards, strings, strict=True)])
    offset = np.concatenate([shard.offset for shard in shards])
    at = place + np.cumsum([0, *(len(shard.data) for shard in shards[:-1])])[which]
    window = (offset + DEPTH <= sizes[string])[at]
    at, block = at[window], block[window]
    string, offset = string[at], offset[at]
    out = np.full(total, NONE)
    if len(block):
        begins = np.flatnonzero(np.concatenate(([True], block[1:] != block[:-1])))
        own = docs[string]
        least, most = np.minimum.reduceat(own, begins), np.maximum.reduceat(own, begins)
        several = (least != most) | np.logical_or.reduceat(multi[string], begins)
        value = np.where(several, least, NONE)
        out[starts[string] + offset] = np.repeat(value, np.diff(np.append(begins, len(block))))
    return out


def _batches(part: np.ndarray, sizes: np.ndarray, about: int) -> list[np.ndarray]:
    """Strings in batches of ``about`` so many bytes that never divide a part: equal windows share one."""
    if not len(part):
        return []
    order = np.argsort(part, kind="stable")
    ends = np.flatnonzero(np.append(part[order][1:] != part[order][:-1], True)) + 1
    bytes_to = np.cumsum(sizes[order])[ends - 1]
    batch = bytes_to // about
    cuts = ends[np.append(batch[1:] != batch[:-1], True)]
    return np.split(order, cuts[:-1])


def _spread(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """``count`` numbers from ``first`` on, for each of them."""
    return np.repeat(first - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))


def _recurring(size: np.ndarray, body: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Whether each window of the strings may be found in them again, and the runs of such windows.

    Runs are given by string, place of the first window in ``body`` and number of windows. A window goes by
    the hash of its bytes: one that is there again is never missed, and the merge tells the others.
    """
    starts, windows = np.cumsum(size) - size, size - DEPTH + 1
    at = _spread(starts, windows)
    mark = contents(body, at, np.full(len(at), DEPTH))
    line = np.sort(mark)
    again = _among(line[1:][line[1:] == line[:-1]], mark)
    of = np.repeat(np.arange(len(size)), windows)[again]
    at = at[again]
    first = np.flatnonzero(np.concatenate(([True], (at[1:] != at[:-1] + 1) | (of[1:] != of[:-1])))) if len(at) else at
    return again, of[first], at[first], np.diff(np.append(first, len(at)))


def window_owners(docs: np.ndarray, multi: np.ndarray, size: np.ndarray, places: np.ndarray, part: np.ndarray, body: np.ndarray):
    """Batches of the different strings, each with the first document of every window; NONE if only one doc has it.

    Windows that no other string has belong to their string's documents. Runs of windows that recur are
    strings of their own, equal ones are made one, and their transforms are merged.
    """
    batches = _batches(part, size, FILTERED)
    recurs, runs = [], []
    for own in batches:
        data = _cut(body, places[own], size[own])
        again, string, at, count = _recurring(size[own], data)
        long, string = count + DEPTH - 1, own[string]
        recurs.append(again)
        runs.append((contents(data, at, long), part[string], docs[string], multi[string], long, _cut(data, at, long)))
    marks, run_part, run_docs, run_multi, long, data = (np.concatenate(c) for c in zip(*runs, strict=True))
    value = np.empty(0, np.int64)
    each = np.empty(0, np.int64)
    if len(marks):
        at, distinct, least, several = _firsts(marks, run_docs, run_multi)
        begins, own_size, windows = (np.cumsum(long) - long)[at], long[at], long[at] - DEPTH + 1
        starts = np.cumsum(windows) - windows
        value = np.empty(int(windows.sum()), np.int64)
        for own in _batches(run_part[at], own_size, BATCH):
            found = first_documents(least[own], several[own], own_size[own], _cut(data, begins[own], own_size[own]))
            value[_spread(starts[own], windows[own])] = found[_spread(np.cumsum(own_size[own]) - own_size[own], windows[own])]
        each = starts[np.searchsorted(distinct, marks)]
    done = 0
    for own, again, run in zip(batches, recurs, runs, strict=True):
        count = run[4] - DEPTH + 1
        owner = np.repeat(np.where(multi[own], docs[own], NONE), size[own] - DEPTH + 1)
        owner[again] = value[_spread(each[done:done + len(count)], count)]
        done += len(count)
        yield own, owner


def _owned(string: np.ndarray, size: np.ndarray, owner: np.ndarray) -> tuple[np.ndarray, ...]:
    """String, begin, end and owner of the runs of windows with one owner; the strings' windows lie one after the other."""
    of = np.repeat(np.arange(len(size)), size)
    begin = np.flatnonzero(np.concatenate(([True], (owner[1:] != owner[:-1]) | (of[1:] != of[:-1]))))
    end = np.append(begin[1:], len(owner))
    real = owner[begin] != NONE
    begin, end = begin[real], end[real]
    of = of[begin]
    at = (np.cumsum(size) - size)[of]
    return string[of], (begin - at).astype(np.uint8), (end - at).astype(np.uint8), owner[begin]


def _merge_task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
    """For each group of documents and stretch: runs of windows that have an earlier owner."""
    out = _owned_runs(rows)
    give_back()
    return out


def _owned_runs(rows: pd.DataFrame) -> pd.DataFrame:
    lengths = [len(x) // 8 for x in rows["hashes"]]
    groups = np.repeat(rows["g"].to_numpy(), lengths)
    hashes = np.concatenate([np.frombuffer(x, np.uint64) for x in rows["hashes"]])
    docs = np.concatenate([np.frombuffer(x, np.int64) for x in rows["docs"]])
    multi = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["multi"]]).astype(bool)
    sizes = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["sizes"]]).astype(np.int64)
    body = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["body"]])
    part = np.concatenate([np.frombuffer(x, np.uint8) for x in rows["parts"]])
    at, distinct, least, several = _firsts(hashes, docs, multi)
    size, places = sizes[at], (np.cumsum(sizes) - sizes)[at]
    found = [_owned(own, size[own] - DEPTH + 1, owner) for own, owner in window_owners(least, several, size, places, part[at], body)]
    of, begin, end, owner = (np.concatenate(c) for c in zip(*found, strict=True))
    order = np.argsort(of, kind="stable")
    of, begin, end, owner = of[order], begin[order], end[order], owner[order]
    first, last = np.searchsorted(of, np.arange(len(size))), np.searchsorted(of, np.arange(len(size)), side="right")
    each = np.searchsorted(distinct, hashes)
    count = last[each] - first[each]
    run = np.repeat(first[each] - (np.cumsum(count) - count), count) + np.arange(int(count.sum()))
    group, mark = np.repeat(groups, count), np.repeat(hashes, count)
    order = np.argsort(group, kind="stable")
    group, mark, run = group[order], mark[order], run[order]
    cuts = np.flatnonzero(np.concatenate(([True], group[1:] != group[:-1], [True]))) if len(group) else np.zeros(1, np.int64)
    out = []
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        r = run[a:b]
        out.append((int(group[a]), mark[a:b].tobytes(), begin[r].tobytes(), end[r].tobytes(), owner[r].tobytes()))
    return pd.DataFrame(out, columns=["g", "hashes", "begins", "ends", "owners"])


def removed_bytes(ids, known, data, offsets, hashes, begins, ends, owners, buckets: int, hot: np.ndarray) -> np.ndarray:
    """Mask of the bytes of the texts in ``data`` that a document with a smaller id owns."""
    cover = np.zeros(len(data) + 1, np.int32)
    text, start, count, anchors = stretches(data, offsets)
    if len(text) and len(hashes):
        text, start, count, _ = divided(data, text, start, count, keys(anchors, buckets), buckets, hot)
        mark = contents(data, start, count + DEPTH - 1)
        first, last = np.searchsorted(hashes, mark), np.searchsorted(hashes, mark, side="right")
        n = last - first
        run = np.repeat(first - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        at, of = np.repeat(start, n), np.repeat(text, n)
        gone = known[of] & (owners[run] < ids[of])
        at, run = at[gone], run[gone]
        np.add.at(cover, at + begins[run], 1)
        np.add.at(cover, at + ends[run] - 1 + DEPTH, -1)
    return np.cumsum(cover[:-1]) > 0


def _apply_task(finish, schema: pa.Schema, buckets: int, hot: np.ndarray):
    def cut(docs: pa.Table, runs: pa.Table) -> pa.Table:
        columns = [
            np.frombuffer(b"".join(runs.column(c).to_pylist()), t)
            for c, t in (("hashes", np.uint64), ("begins", np.uint8), ("ends", np.uint8), ("owners", np.int64))
        ]
        order = np.argsort(columns[0], kind="stable")
        hashes, begins, ends, owners = (c[order] for c in columns)
        begins, ends = begins.astype(np.int64), ends.astype(np.int64)
        out = []
        for batch, first, end, ids, known, data, offsets in _runs(docs) if docs.num_rows else ():
            mask = removed_bytes(ids, known, data, offsets, hashes, begins, ends, owners, buckets, hot)
            out.append(finish(batch.slice(first, end - first), data, offsets, mask))
        return pa.Table.from_batches(out, schema) if out else schema.empty_table()

    def task(docs: pa.Table, runs: pa.Table) -> pa.Table:
        out = cut(docs, runs)
        give_back()
        return out

    return task


def _digests(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    sums = np.concatenate(([0], np.cumsum(mask)))
    opens = mask.copy()
    opens[1:] &= ~mask[:-1]
    heads = offsets[:-1][np.diff(offsets) > 0]
    opens[heads] = mask[heads]
    spans = np.concatenate(([0], np.cumsum(opens)))
    size, removed = np.diff(offsets), sums[offsets[1:]] - sums[offsets[:-1]]
    found = [
        hashlib.sha256((data[a:b][~mask[a:b]] if r else data[a:b]).tobytes()).hexdigest()
        for a, b, r in zip(offsets[:-1].tolist(), offsets[1:].tolist(), removed.tolist(), strict=True)
    ]
    return pa.record_batch(
        [part.column("doc_id"), pa.array(size), pa.array(removed), pa.array(spans[offsets[1:]] - spans[offsets[:-1]]), pa.array(found)],
        ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
    )


def _kept_texts(part: pa.RecordBatch, data: np.ndarray, offsets: np.ndarray, mask: np.ndarray) -> pa.RecordBatch:
    """Texts without the removed bytes; of a character that is cut nothing stays."""
    was = part.column("text").is_null().to_pylist() if "text" in part.schema.names else []
    left = [
        None if null else data[a:b][~mask[a:b]].tobytes().decode("utf-8", "ignore")
        for a, b, null in zip(offsets[:-1].tolist(), offsets[1:].tolist(), was, strict=True)
    ]
    return pa.record_batch([part.column("row"), pa.array(left, pa.string())], ["row", "text"])


def _removal(rows: DataFrame, carried: list[str], finish, names: list[tuple[str, T.DataType]], arrow: pa.Schema, group: int, hot: int) -> DataFrame:
    """``finish`` over all groups of documents of ``rows`` (doc_id, text and ``carried`` columns)."""
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    groups = max(1, -(-size // group))
    buckets = 2 * groups
    dealt = rows.withColumn("g", F.pmod(F.xxhash64(F.coalesce("doc_id", F.lit(0))), F.lit(groups)).cast("bigint"))
    narrow = dealt.where("doc_id is not null").select("g", F.coalesce("text", F.lit("")).alias("text"))
    anchors = narrow.mapInArrow(tidy(_anchor_task(buckets)), "bucket bigint, anchors binary, groups binary, counts binary")
    shared = kept(anchors.groupBy("bucket").applyInPandas(_shared_anchors(hot), "g bigint, bucket bigint, anchors binary"), "shared-anchors")
    many = _keys_of((r["bucket"], r["anchors"]) for r in shared.where("g < 0").select("bucket", "anchors").collect())
    shared = shared.where("g >= 0")
    plain = dealt.select("g", "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    stretch = _with_group(plain.groupBy("g").cogroup(shared.groupBy("g")), _stretch_task(buckets, many))
    runs = kept(stretch.groupBy("bucket").applyInPandas(_merge_task, "g bigint, hashes binary, begins binary, ends binary, owners binary"), "shared-runs")
    ended = dealt.select("g", "doc_id", "text", *carried).groupBy("g").cogroup(runs.groupBy("g"))
    return ended.applyInArrow(_apply_task(finish, arrow, buckets, many), T.StructType([T.StructField(n, t) for n, t in names]))


def _with_group(pair, task) -> DataFrame:
    def named(key, docs: pa.Table, other: pa.Table) -> pa.Table:
        out = task(docs, other)
        give_back()
        return out.append_column("g", pa.array([key[0].as_py()] * out.num_rows, pa.int64()))

    return pair.applyInArrow(named, "bucket bigint, parts binary, hashes binary, docs binary, multi binary, sizes binary, body binary, g bigint")


def removed_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", group: int = GROUP, hot: int = HOT) -> DataFrame:
    """doc_id, n_bytes, n_removed, n_spans and kept_sha256 of every row.

    A byte goes if it is in a string of DEPTH bytes that also begins in a document with a smaller
    key, overlaps included, all judged on the given texts; matches do not cross documents.

    Documents are dealt by the hash of their key into groups of about ``group`` bytes. Anchors go
    to buckets, at most two for an anchor, task and group, and come back where another document has
    them; stretches go to buckets with each group's least key, each once a group, and come back as
    runs with the least key of all. So a passage in a third of all documents is one row a group.
    An anchor with ``hot`` stretches or more is divided by its windows, so a short line in a third
    of all documents, with other text around it in each, is no group. The keys of such anchors go to
    every task: one for ``hot`` stretches at most.
    Strings and anchors are told apart by 64-bit hashes.

    Null and empty texts have no bytes. Rows without a key lose nothing and take nothing away.
    Repeated rows of one key do not remove each other. An empty table gives no rows. Other
    columns are not looked at. A text may have up to 256 MB.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    names = [("doc_id", T.LongType()), ("n_bytes", T.LongType()), ("n_removed", T.LongType()), ("n_spans", T.LongType()), ("kept_sha256", T.StringType())]
    arrow = pa.schema([("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()), ("n_spans", pa.int64()), ("kept_sha256", pa.string())])
    return _removal(rows, [], _digests, names, arrow, group, hot)


def without_passages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", length: str | None = "n_chars", group: int = GROUP,
                     hot: int = HOT) -> DataFrame:
    """The rows of ``docs`` with what ``removed_passages`` removes cut out of their texts.

    Column ``length``, where there is one, is set to the new number of characters of rows with a text.
    """
    from pyspark.sql.pandas.types import to_arrow_schema

    others = [c for c in docs.columns if c != text]
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.col(text).alias("text"), F.struct(*others).alias("row"))
    names = [("row", rows.schema["row"].dataType), ("text", T.StringType())]
    arrow = to_arrow_schema(T.StructType([T.StructField(n, t) for n, t in names]))
    cut = _removal(rows, ["row"], _kept_texts, names, arrow, group, hot)
    columns = [F.col("text").alias(text) if c == text else F.col(f"row.{c}").alias(c) for c in docs.columns]
    cut = cut.select(*columns)
    if length in docs.columns:
        cut = cut.withColumn(length, F.when(F.col(text).isNotNull(), F.length(text)).otherwise(F.col(length)).cast(docs.schema[length].dataType))
    return cut
