"""Near copies among texts and vectors, and components, against brute force."""

import math
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from llm_cases import by_id, documents, edge_rows, prose

from marketspark.llm import hashing, minhash, vectors
from marketspark.llm.graph import components
from pyspark.sql import functions as F


def roots(nodes, links):
    parent = {n: n for n in nodes}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def test_components_of_chains_stars_and_loops(spark):
    rng = random.Random(3)
    links = [(i, i + 1) for i in range(40)] + [(100, i) for i in range(101, 140)] + [(200, 200)]
    links += [(rng.randrange(300, 400), rng.randrange(300, 400)) for _ in range(60)]
    found = components(spark.createDataFrame([*links, (None, 5), (7, None)], "a bigint, b bigint")).collect()
    real = [x for x in links if x[0] != x[1]]
    expected = roots({n for x in real for n in x}, real)
    assert {r["node"]: r["component"] for r in found} == expected
    assert len(found) == len(expected)
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0


def shingles(text, n):
    words = re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower())
    if not words:
        return set()
    return {tuple(words[i:i + n]) for i in range(len(words) - n + 1)} if len(words) >= n else {tuple(words)}


def brute_documents(rows, n=5, percent=80):
    sets = {r[0]: shingles(r[1], n) for r in rows if r[0] is not None}
    ids = sorted(sets)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
        if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= percent * len(sets[a] | sets[b])
    ]
    return sets, roots(ids, links)


def families(seed=5):
    """Copies that are changed a little, chains of changes, and texts that share a passage."""
    rng = random.Random(seed)
    rows, at = [], 1000
    for family in range(8):
        words = prose(family, 150).split()
        for _ in range(12):
            own = list(words)
            for _ in range(rng.randrange(0, 9)):
                own[rng.randrange(len(own))] = f"w{rng.randrange(10**6)}"
            rows.append((at, " ".join(own), "en", "a", 1))
            at += 7
            if rng.random() < 0.3:
                words = own
    passage = prose(77, 60)
    for i in range(40):
        rows.append((at + i, prose(500 + i, 80) + " " + passage, "en", "b", 1))
    return rows


@pytest.mark.parametrize("n", [4, 5])
def test_documents_against_all_pairs(spark, n):
    rows = edge_rows() + families()
    sets, expected = brute_documents(rows, n)
    found = minhash.near_documents(documents(spark, rows, extra=True), words=n).collect()
    assert len(found) == len(rows)
    for r in found:
        if r["doc_id"] is None:
            assert r["component_id"] is None and r["kept"]
        else:
            assert r["n_shingles"] == len(sets[r["doc_id"]])
            assert r["component_id"] == expected[r["doc_id"]], r
            assert r["kept"] == (r["doc_id"] == r["component_id"])


@pytest.mark.parametrize("block,items", [(5, 10**9), (10**6, 600), (10**6, 10**9)])
def test_small_blocks_and_few_salts_change_nothing(spark, monkeypatch, block, items):
    rows = families(9)
    _, expected = brute_documents(rows)
    monkeypatch.setattr(minhash, "SMALL_IDS", 3)
    monkeypatch.setattr(minhash, "SALT_ROWS", 2)
    reps = minhash.signatures(documents(spark, rows)).select("doc_id", "n_shingles", "signature")
    posted = minhash.with_hubs(minhash.postings(reps))
    alone = spark.createDataFrame([], "node bigint, component bigint")
    near = minhash.agreeing(posted.where("doc_id <> hub").selectExpr("hub as a", "doc_id as b").distinct(), reps)
    hubs = minhash.confirmed(near, documents(spark, rows), key="doc_id", text="text")
    links = minhash.crossing(posted, reps, alone, documents(spark, rows), key="doc_id", text="text", block=block, items=items)
    assert hubs.count() > 20 and links.count() < len(rows) * len(rows) / 20
    assert roots([r[0] for r in rows], [tuple(r) for r in links.collect()]) == expected


def test_no_documents(spark):
    assert minhash.near_documents(documents(spark, [])).count() == 0
    assert minhash.one_of_each(documents(spark, [])).count() == 0


def test_one_of_each_keeps_rows_whole(spark):
    rows = edge_rows()
    _, expected = brute_documents(rows)
    left = minhash.one_of_each(documents(spark, rows, extra=True))
    assert left.columns == documents(spark, rows, extra=True).columns
    ids = [r["doc_id"] for r in left.collect()]
    assert sorted(i for i in ids if i is not None) == sorted({i for i in expected if expected[i] == i})
    assert sum(i is None for i in ids) == 2


def test_words_are_ascii_blank_separated():
    import pyarrow as pa

    texts = ["a\x0bb\x0cc", None, "", "É é x", "  x", "x  "]
    for _, end, data, offsets in hashing.texts(pa.array(texts)):
        hashes, at = hashing.words(data, offsets)
        assert end == len(texts)
        assert np.diff(at).tolist() == [3, 0, 0, 2, 1, 1]
        assert hashes[at[4]] == hashes[at[5]]


def cosine(a, b):
    return sum(x * y for x, y in zip(a, b, strict=True)) / math.sqrt(sum(x * x for x in a)) / math.sqrt(sum(x * x for x in b))


def vector_rows():
    rng = np.random.default_rng(8)
    rows, at = [], 0
    for label in (1, 2, 3):
        for _ in range(6):
            center = rng.standard_normal(16)
            for _ in range(rng.integers(1, 9)):
                v = center + rng.standard_normal(16) * rng.choice([0.0, 0.05, 0.1, 0.2])
                rows.append((at, [float(np.float32(x)) for x in v], label))
                at += 1
    rows += [(at, rows[0][1], 1), (at + 1, rows[0][1], 2), (at + 2, rows[0][1], None), (at + 3, None, 1), (at + 4, [0.0] * 16, 1),
             (at + 5, [None] + [1.0] * 15, 1), (at + 6, [float("nan")] * 16, 1), (at + 7, [float("inf")] + [1.0] * 15, 1), (at + 8, [], 1),
             (at + 9, rows[0][1][:8], 1), (at + 10, [2 * x for x in rows[0][1]], 1), (None, rows[0][1], 1)]
    return rows


@pytest.mark.parametrize("tile", [3, 2048])
def test_vectors_against_all_pairs(spark, tile):
    rows = vector_rows()
    df = spark.createDataFrame(rows, "vec_id bigint, embedding array<float>, label int")
    df = df.withColumns({c: F.lit("clash") for c in ("rep", "copies", "vector", "tile", "links", "ok")})
    good = {
        r[0]: r for r in rows
        if r[0] is not None and r[1] and r[2] is not None and all(x is not None and math.isfinite(x) for x in r[1]) and any(r[1])
    }
    ids = sorted(good)
    links = [
        (a, b) for i, a in enumerate(ids) for b in ids[i + 1:]
        if good[a][2] == good[b][2] and len(good[a][1]) == len(good[b][1]) and cosine(good[a][1], good[b][1]) >= 0.98
    ]
    named = roots(ids, links)
    expected = []
    for r in rows:
        n = sum(r[0] in x for x in links)
        component = named.get(r[0], r[0])
        expected.append((r[0], n, component, r[0] == component))
    found = [tuple(r) for r in vectors.near_vectors(df, tile=tile).collect()]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_no_vectors(spark):
    assert vectors.near_vectors(spark.createDataFrame([], "vec_id bigint, embedding array<float>, label int")).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(2)
    x = rng.standard_normal((200, 33)) * rng.choice([1.0, 100.0], (200, 33))
    x /= np.linalg.norm(x, axis=1, keepdims=True)
    q, s, e = vectors.quantised(x)
    apart = np.abs(x @ x.T - vectors._products(q, q) * (s[:, None] * s))
    assert (apart <= (1 + e[:, None]) * e + e[:, None] + 1e-12).all()


def test_rows_of_one_key_stay_one_document(spark):
    rows = [(1, "a b c d e f g", None, None, None)] * 3 + [(2, "a b c d e f g", None, None, None)]
    found = minhash.near_documents(documents(spark, rows)).collect()
    assert by_id(found, "component_id", "kept") == [(False, 1, 1, True)] * 3 + [(False, 2, 1, False)]
    assert minhash.one_of_each(documents(spark, rows)).count() == 1


@pytest.mark.parametrize("percent", [50, 60, 70, 80, 95])
def test_pairs_at_the_least_share_are_hardly_missed(percent):
    rng = np.random.default_rng(percent)
    matches = minhash.enough(percent)
    agreeing = rng.binomial(minhash.COORDINATES, percent / 100, 200_000)
    assert (agreeing < matches).mean() <= 1e-4
    assert (agreeing < matches + 4).any()


def test_least_shares_that_signatures_do_not_cover_are_refused():
    assert minhash.enough(80) == 36
    with pytest.raises(ValueError, match="percent"):
        minhash.enough(5)


@pytest.mark.parametrize("rows_a_batch", [1, 3, 1000])
def test_tiles_come_whole_from_batches_of_any_size(rows_a_batch):
    """Many small lists are met by one task, row by row the same as each list alone."""
    rng = np.random.default_rng(5)
    rows = []
    for hub in range(40):
        base = rng.integers(0, 1 << 32, 64, dtype=np.uint32)
        for i in range(int(rng.integers(1, 9))):
            mark = base.copy()
            other = int(rng.integers(0, 60))
            mark[:other] = rng.integers(0, 1 << 32, other, dtype=np.uint32)
            rows.append((hub, 0, hub % 2, hub * 100 + i, i % 3, i % 2 if hub % 2 else 0, 50 + i // 2, mark))
    names = ["hub", "low", "high", "doc_id", "component", "block", "n_shingles", "signature"]
    table = pa.table([*(pa.array([r[c] for r in rows], pa.int64()) for c in range(7)), pa.array([r[7].tobytes() for r in rows])], names)
    expected = set()
    for a in rows:
        for b in rows:
            apart = a[0] == b[0] and a[4] != b[4] and (a[1] == a[2] or a[5] != b[5])
            if apart and (a[7] == b[7]).sum() >= 30 and 100 * min(a[6], b[6]) >= 80 * max(a[6], b[6]):
                expected.add((*a[:4], a[5]))
    found = minhash._met_task(30, 80)(iter(table.to_batches(max_chunksize=rows_a_batch)))
    found = [tuple(r.values()) for batch in found for r in batch.to_pylist()]
    assert len(found) == len(set(found)) and set(found) == expected
    assert 20 < len(expected) < len(rows)
