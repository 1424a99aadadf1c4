"""Mixing and sharding against plain Python."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import pytest
from llm_cases import documents, edge_rows, prose, same_columns

from marketspark.llm import mixing, sharding
from pyspark.sql import functions as F


def size(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def draw(i, seed):
    return (int(hashlib.md5(f"{seed}:{'null' if i is None else i}".encode()).hexdigest()[:13], 16) + 0.5) / 2**52


def brute(rows, weights=(3, 1, 2)):
    sizes = defaultdict(int)
    for r in rows:
        sizes[r[3]] += size(r[1])
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: weights[i % 3] for i, s in enumerate(names)}
    left, open_sources, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_sources:
        share = left / sum(weight[s] for s in open_sources)
        full = [s for s in open_sources if share * weight[s] >= 2 * sizes[s]]
        for s in full or list(open_sources):
            target[s] = 2.0 * sizes[s] if full else share * weight[s]
            left -= target[s] if full else 0
            open_sources.discard(s)
    out = []
    for s in names:
        own = [r for r in rows if r[3] == s]

        def key(r):
            letters = len(re.sub("[^A-Za-z]", "", r[1] or "")) / len(r[1]) if r[1] else 0.0
            return -math.log(draw(r[0], 17)) / (0.5 + letters)

        epochs = math.floor(target[s] / sizes[s]) if sizes[s] else 0
        rest, before = target[s] - epochs * sizes[s], 0
        for r in sorted(own, key=lambda r: (key(r), str(r[0]))):
            drawn = 2 * before + size(r[1]) <= 2 * rest
            before += size(r[1])
            out.append((r[0], size(r[1]), sizes[s], target[s], (epochs + drawn) * size(r[1])))
    return out


def test_mix_against_sorting(spark):
    rows = [r for r in edge_rows() if r[0] is not None and r != (0, *r[1:])]
    rows = list({r[0]: r for r in rows}.values()) + [(5000 + i, prose(i, 5 + i % 90), "en", "hot", 1) for i in range(400)]
    found = mixing.mix(documents(spark, rows, extra=True)).collect()
    got = {r["doc_id"]: (r["size"], r["source_size"], r["target"], r["taken"]) for r in found}
    assert len(found) == len(rows)
    for i, n, whole, target, taken in brute(rows):
        assert got[i][:2] == (n, whole)
        assert got[i][2] == pytest.approx(target)
        assert got[i][3] == taken, i
        assert taken <= 2 * n


def test_mix_with_nulls_ties_and_repeated_rows(spark):
    rows = edge_rows()
    df = documents(spark, rows, extra=True)
    found = mixing.mix(df).collect()
    assert len(found) == len(rows)
    taken, targets = Counter(), {}
    for r in found:
        taken[r["source"]] += r["taken"]
        targets[r["source"]] = r["target"]
    largest = max(size(r[1]) for r in rows)
    assert all(abs(taken[s] - targets[s]) <= largest for s in targets)
    mixed = mixing.mixed_documents(df)
    assert same_columns(mixed, df)
    assert mixed.count() == sum(r["copies"] for r in found)
    assert mixing.mix(documents(spark, [])).count() == 0
    assert mixing.mixed_documents(documents(spark, [])).count() == 0


def test_weight_draws_more_often(spark):
    rows = [(i, "w " * 10, "en", "abc"[i % 3], 1) for i in range(3000)]
    df = documents(spark, rows).withColumn("w", F.when(F.col("doc_id") % 2 == 0, 4.0).otherwise(1.0))
    found = mixing.mix(df, weight=F.col("w"), share=(1, 2)).collect()
    even = sum(r["copies"] for r in found if r["doc_id"] % 2 == 0)
    assert even > 1.4 * sum(r["copies"] for r in found if r["doc_id"] % 2)


def test_native(spark):
    plan = mixing.mix(documents(spark, edge_rows()))._jdf.queryExecution().toString()
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan


def test_shards_hold_the_mixture(spark):
    rows = edge_rows() + [(5000 + i, prose(i, 3), "en", "hot", 1) for i in range(1000)]
    found = sharding.interleave(documents(spark, rows, extra=True), buckets=16).collect()
    assert len(found) == len(rows)
    shards = defaultdict(list)
    for r in found:
        shards[r["shard"]].append(r)
    assert set(shards) == set(range(8))
    sizes = [len(v) for v in shards.values()]
    assert max(sizes) - min(sizes) <= 1
    by_source = Counter(r[3] for r in rows)
    for own in shards.values():
        assert sorted(r["slot"] for r in own) == list(range(len(own)))
        for source, n in Counter(r["source"] for r in own).items():
            assert abs(n - by_source[source] / 8) <= len(by_source) / 2 + 1
    expected = Counter((r[0], len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode())) for r in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in found) == expected


def brute_shards(rows, shards=8):
    marked = [(draw(r[0], 29), r[0] is not None, r[0] or 0, len((r[1] or "").encode()) + 1, zlib.crc32((r[1] or "").encode()), r[3]) for r in rows]
    sources = defaultdict(list)
    for m in marked:
        sources[m[5]].append(m)
    placed = []
    for source, own in sources.items():
        for rank, m in enumerate(sorted(own, key=lambda m: m[:5])):
            placed.append(((rank + m[0]) / len(own), source is not None, source or "", *m[1:5]))
    out = []
    for at, p in enumerate(sorted(placed)):
        shard = at * shards // len(placed)
        out.append((p[4] if p[3] else None, p[5], p[6], shard, at - math.ceil(shard * len(placed) / shards)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("buckets", [1, 16, 1024])
def test_shards_against_plain_sorting(spark, buckets):
    rows = edge_rows() + [(5000 + i, prose(i, 3), "en", ["hot", f"own{i}"][i % 2], 1) for i in range(500)]
    found = sharding.interleave(documents(spark, rows, extra=True), buckets=buckets).collect()
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found), key=repr) == brute_shards(rows)


def test_many_sources_of_one_row_spread_over_places(spark):
    rows = [(i, "x", "en", f"s{i}", 1) for i in range(4000)]
    found = sharding.interleave(documents(spark, rows))
    fullest = found.groupBy(F.floor(F.col("place") * 64).alias("b")).count().agg(F.max("count")).first()[0]
    assert fullest < 110


def test_bucket_counts_do_not_change_shards(spark):
    rows = [(i, prose(i, 3), "en", "ab"[i % 7 == 0], 1) for i in range(300)]
    one, many = (
        {r["doc_id"]: (r["shard"], r["slot"]) for r in sharding.interleave(documents(spark, rows), buckets=b).collect()} for b in (1, 64)
    )
    assert one == many
    assert sharding.interleave(documents(spark, [])).count() == 0


def test_fewer_rows_than_shards(spark):
    found = sharding.interleave(documents(spark, edge_rows()[:3])).collect()
    assert [r["slot"] for r in found] == [0, 0, 0]
    assert len({r["shard"] for r in found}) == 3
