"""Passages removed, against brute force over all windows; transforms against sorting."""

import hashlib
import random
import tracemalloc

import numpy as np
import pandas as pd
import pyarrow as pa
import pytest
from llm_cases import documents, edge_rows, prose, same_columns

from marketspark.llm import bwt, suffixes


def brute(rows):
    first = {}
    for i, text, *_ in rows:
        b = (text or "").encode()
        for k in range(len(b) - 49):
            if i is not None:
                first[b[k:k + 50]] = min(i, first.get(b[k:k + 50], i))
    out = []
    for i, text, *_ in rows:
        b = (text or "").encode()
        mask = np.zeros(len(b), bool)
        for k in range(len(b) - 49):
            if i is not None and first[b[k:k + 50]] < i:
                mask[k:k + 50] = True
        spans = int((mask & ~np.concatenate(([False], mask[:-1]))).sum())
        left = np.frombuffer(b, np.uint8)[~mask].tobytes()
        out.append((i, len(b), int(mask.sum()), spans, left))
    return out


def passages(seed):
    """Texts cut from a few common pieces at random places, so that matches overlap and touch."""
    rng = random.Random(seed)
    pieces = [prose(900 + i, 30) for i in range(6)] + ["ab" * 60, "ü" * 70]
    rows = []
    for i in range(60):
        parts = []
        for _ in range(rng.randrange(1, 5)):
            p = rng.choice(pieces)
            a = rng.randrange(0, len(p) // 2)
            parts.append(p[a:a + rng.randrange(20, len(p))])
        rows.append((2000 + rng.randrange(10_000), rng.choice(["", " ", "zz"]).join(parts), "en", "a", 1))
    return rows


@pytest.mark.parametrize("group", [1 << 23, 2000])
def test_removed_passages_against_all_windows(spark, group, monkeypatch):
    rows = [r for r in edge_rows() if r[0] not in (8, 9)] + [(8, prose(1, 3000), "en", "a", 1), (9, prose(1, 3000)[500:], "en", "b", 1)]
    rows += passages(4)
    found = suffixes.removed_passages(documents(spark, rows, extra=True), group=group).collect()
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_texts_without_passages(spark):
    rows = [r for r in edge_rows() if r[0] not in (8, 9)] + passages(6)
    df = documents(spark, rows, extra=True)
    left = suffixes.without_passages(df, group=4000)
    assert same_columns(left, df)
    expected = [(r[0], None if old[1] is None else r[4].decode("utf-8", "ignore"), old[2]) for r, old in zip(brute(rows), rows, strict=True)]
    found = left.collect()
    assert sorted(((r["doc_id"], r["text"], r["lang"]) for r in found), key=repr) == sorted(expected, key=repr)
    assert all(r["n_chars"] == len(r["text"]) for r in found if r["text"] is not None)


def test_no_documents(spark):
    assert suffixes.removed_passages(documents(spark, [])).count() == 0
    assert suffixes.without_passages(documents(spark, [])).count() == 0


@pytest.mark.parametrize("parts", [1, 2, 5, 11])
def test_merged_transforms_order_and_group_rotations(parts):
    rng = np.random.default_rng(parts)
    strings = [rng.integers(97, 99, rng.integers(50, 90)).astype(np.uint8) for _ in range(30)]
    strings += [np.concatenate((strings[i][5:], strings[i + 1][:20])) for i in range(8)]
    shards = []
    for own in np.array_split(np.arange(len(strings)), parts):
        ended = [np.append(strings[i], bwt.STOP).astype(np.uint8) for i in own]
        sizes = np.array([len(x) for x in ended])
        shards.append(bwt.Shard(np.concatenate(ended), np.cumsum(sizes) - sizes))

    def prefix(s, p):
        start = shards[s].starts[shards[s].string[p]]
        n = shards[s].length[p]
        return bytes(shards[s].data[start + (shards[s].offset[p] + np.arange(bwt.DEPTH)) % n])

    shard, place, block = bwt.common_prefixes(shards)
    texts = [prefix(s, p) for s, p in zip(shard, place, strict=True)]
    assert texts == sorted(texts)
    assert len(set(zip(shard.tolist(), place.tolist(), strict=True))) == sum(len(s.data) for s in shards)
    assert (np.diff(block) == [a != b for a, b in zip(texts[:-1], texts[1:], strict=True)]).all()


def lined(n):
    """A line of 40 bytes with different text around it, and each tenth time with the same."""
    line = "this short line is in all the documents."
    return [(7000 + i, f"{prose(i // 10 * 10 if i % 10 < 2 else 500 + i, 12)} {line} {prose(90_000 + i, 12)}", "en", "a", 1) for i in range(n)]


@pytest.mark.parametrize("hot", [1, 30])
def test_frequent_anchors_divided_by_their_windows(spark, hot):
    rows = [r for r in edge_rows() if r[0] not in (8, 9)] + passages(5) + lined(200)
    found = suffixes.removed_passages(documents(spark, rows), group=4000, hot=hot).collect()
    expected = [(*r[:4], hashlib.sha256(r[4]).hexdigest()) for r in brute(rows)]
    assert sorted(map(tuple, found), key=repr) == sorted(expected, key=repr)


def test_no_bucket_holds_a_frequent_anchor():
    """One short line in many documents is found to be hot, and its windows are spread over the buckets."""
    rows, buckets = lined(2000), 16
    docs = pa.table({"g": [0] * len(rows), "doc_id": [r[0] for r in rows], "text": [r[1] for r in rows]})
    anchors = pd.concat([b.to_pandas() for b in suffixes._anchor_task(buckets)(iter(docs.to_batches()))])
    shared = pd.concat([suffixes._shared_anchors(1000)((b,), part) for b, part in anchors.groupby("bucket")])
    many = shared[shared.g < 0]
    hot = suffixes._keys_of(zip(many["bucket"], many["anchors"], strict=True))
    assert 1 <= len(hot) < 10
    wanted = pa.Table.from_pandas(shared[shared.g >= 0])

    def bytes_of_buckets(hot):
        out = suffixes._stretch_task(buckets, hot)(docs, wanted).to_pandas()
        sizes = out["body"].map(len).groupby(out["bucket"]).sum()
        return sizes.max() / sizes.sum()

    assert bytes_of_buckets(hot[:0]) > 0.3
    assert bytes_of_buckets(hot) < 0.15


def shared_stretches(n):
    """One bucket's rows of two groups of documents that have all their stretches in common."""
    rng = np.random.default_rng(7)
    body = rng.integers(97, 123, n * 84).astype(np.uint8)
    hashes = suffixes.contents(body, np.arange(n) * 84, np.full(n, 84))
    part = np.sort(rng.integers(0, 256, n)).astype(np.uint8)
    row = {"parts": part.tobytes(), "hashes": hashes.tobytes(), "multi": bytes(n), "sizes": bytes([84]) * n, "body": body.tobytes()}
    return pd.DataFrame([{"bucket": 0, "g": g, "docs": np.full(n, 5 - g, np.int64).tobytes(), **row} for g in (0, 1)])


def test_a_merging_task_holds_few_times_its_strings():
    rows = shared_stretches(12_000)
    tracemalloc.start()
    found = suffixes._merge_task((0,), rows)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert most < 12 * rows["body"].map(len).sum()
    for _, r in found.iterrows():
        assert set(r["begins"]) == {0} and set(r["ends"]) == {35} and len(r["begins"]) == 12_000
        assert set(np.frombuffer(r["owners"], np.int64)) == {4}


@pytest.mark.parametrize("stride", [1, 3, 4, 5, 6])
def test_steps_of_any_width_give_one_order(stride, monkeypatch):
    rng = np.random.default_rng(1)
    strings = [rng.integers(97, 99, rng.integers(50, 85)).astype(np.uint8) for _ in range(40)]
    shards = []
    for own in (strings[:25], strings[25:] + strings[:5]):
        ended = [np.append(x, bwt.STOP).astype(np.uint8) for x in own]
        sizes = np.array([len(x) for x in ended])
        shards.append(bwt.Shard(np.concatenate(ended), np.cumsum(sizes) - sizes))
    usual = bwt.common_prefixes(shards)
    monkeypatch.setattr(bwt, "STRIDE", stride)
    for a, b in zip(usual, bwt.common_prefixes(shards), strict=True):
        assert (a == b).all()


def test_a_merge_of_few_strings_takes_nine_steps(monkeypatch):
    sort, sorts = np.sort, []
    monkeypatch.setattr(np, "sort", lambda x: sorts.append(len(x)) or sort(x))
    bwt.merged([np.zeros(100, np.uint64), np.zeros(50, np.uint64)])
    assert sorts == [150] * 9


def edged(n, size, parts, seed):
    """Strings around common pieces with other bytes at both ends, some strings with several documents."""
    rng = np.random.default_rng(seed)
    pieces = rng.integers(97, 123, (parts, size)).astype(np.uint8)
    of = np.sort(rng.integers(0, parts, n))
    ends = [(rng.integers(97, 123, rng.integers(0, 12)).astype(np.uint8), rng.integers(97, 123, rng.integers(0, 12)).astype(np.uint8)) for _ in of]
    strings = [np.concatenate((a, pieces[p], b)) for p, (a, b) in zip(of, ends, strict=True)]
    return strings, rng.permutation(n).astype(np.int64), rng.integers(0, 4, n) == 0, of.astype(np.uint8)


def owners_of(strings, docs, multi, part):
    sizes = np.array([len(x) for x in strings])
    body = np.concatenate(strings)
    out = [None] * len(strings)
    for own, owner in suffixes.window_owners(docs, multi, sizes, np.cumsum(sizes) - sizes, part, body):
        for i, found in zip(own, np.split(owner, np.cumsum(sizes[own] - 49)[:-1]), strict=True):
            out[i] = found.tolist()
    return out


@pytest.mark.parametrize("filtered", [1 << 17, 500])
@pytest.mark.parametrize("size", [45, 60])
def test_owners_of_windows_of_recurring_runs(size, filtered, monkeypatch):
    monkeypatch.setattr(suffixes, "FILTERED", filtered)
    strings, docs, multi, part = edged(150, size, 9, size)
    strings, docs, multi, part = zip(*[x for x in zip(strings, docs, multi, part, strict=True) if len(x[0]) >= 50], strict=True)
    strings, docs, multi, part = list(strings), np.array(docs), np.array(multi), np.array(part)
    own = {}
    for text, doc, several in zip(strings, docs, multi, strict=True):
        for k in range(len(text) - 49):
            own.setdefault(text[k:k + 50].tobytes(), []).extend([doc, None] if several else [doc])
    least = {w: min(d for d in found if d is not None) if len(set(found)) > 1 else suffixes.NONE for w, found in own.items()}
    assert owners_of(strings, docs, multi, part) == [[least[t[k:k + 50].tobytes()] for k in range(len(t) - 49)] for t in strings]


def test_only_what_recurs_is_merged(monkeypatch):
    """Of strings that differ around a common piece the piece alone is merged, and once."""
    given, merge = [], suffixes.first_documents
    monkeypatch.setattr(suffixes, "first_documents", lambda *a: given.append(int(a[2].sum())) or merge(*a))
    piece = np.random.default_rng(3).integers(97, 123, 60).astype(np.uint8)
    strings = [np.concatenate((np.full(12, 128 + i, np.uint8), piece, np.full(12, 128 + i, np.uint8))) for i in range(40)]
    found = owners_of(strings, np.arange(40) + 5, np.zeros(40, bool), np.zeros(40, np.uint8))
    assert given == [60]
    assert found == [[suffixes.NONE] * 12 + [5] * 11 + [suffixes.NONE] * 12] * 40
