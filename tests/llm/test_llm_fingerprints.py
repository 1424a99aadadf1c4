"""Closed syncmers and edited texts against plain Python."""

import hashlib
import re

import pytest
import xxhash
from llm_cases import documents, edge_rows, prose
from pyspark.sql import functions as F

from marketspark.llm import fingerprints


def signed(x):
    return x - (1 << 64) if x >> 63 else x


def number_hash(values):
    out = 42
    for v in values:
        out = xxhash.xxh64_intdigest(v.to_bytes(8, "little", signed=True), seed=out)
    return signed(out)


def chained(values):
    out = 42
    for v in values:
        out = number_hash([out, v])
    return out


def anchors(text, kept=64, k=5, s=2):
    pieces = [signed(xxhash.xxh64_intdigest(x.encode(), seed=42)) for x in re.findall(r"[^\x20\x09-\x0D]{1,4}", text or "")]
    if len(pieces) < k:
        found = [(chained(pieces), 0)] if pieces else []
    else:
        found = []
        for i in range(len(pieces) - k + 1):
            inner = [number_hash(pieces[j:j + s]) for j in range(i, i + k - s + 1)]
            if min(inner[0], inner[-1]) == min(inner):
                found.append((number_hash(pieces[i:i + k]), i))
    first = {}
    for h, i in found:
        first.setdefault(h, i)
    return sorted(first.items())[:kept]


def printed(found):
    return " ".join(f"{h % (1 << 64):x}@{i}" for h, i in found).lower()


def like(a, b, kept=64):
    a, b = {h for h, _ in a}, {h for h, _ in b}
    least = set(sorted(a | b)[:kept])
    return len(a & b & least) / len(least) if least else 1.0


def brute(rows, kept=64):
    tie = {r[1] or "": signed(xxhash.xxh64_intdigest((r[1] or "").encode(), seed=42)) for r in rows}
    order = sorted(((r[0] is not None, r[0] or 0, tie[r[1] or ""], r[1] or "") for r in rows), reverse=True)
    out = []
    for at, (known, i, _, text) in enumerate(order):
        following = order[(at + 1) % len(order)][3]
        cut = len(text) // 3
        edited = text[:len(text) - cut] + following[:cut]
        a, b, c = (anchors(t, kept) for t in (text, edited, following))
        out.append((i if known else None, len(text), hashlib.sha256(edited.encode()).hexdigest(), printed(a), printed(b), like(a, b, kept), like(a, c, kept)))
    return sorted(out, key=repr)


@pytest.mark.parametrize("block_rows", [4, 4096])
def test_fingerprints_against_plain_python(spark, block_rows):
    rows = edge_rows() + [(3000 + i, prose(i, i), "en", "a", 1) for i in range(30)] + [(77, f"tied id {i} with its own words", "en", "a", 1) for i in range(12)]
    got = fingerprints.compare_edited(documents(spark, rows, extra=True), block_rows=block_rows)
    assert got.columns == ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows)


def test_one_row_and_no_rows(spark):
    one = [(5, prose(1, 50), "en", "a", 1)]
    got = fingerprints.compare_edited(documents(spark, one)).collect()
    assert [tuple(r) for r in got] == brute(one) and got[0]["near_next"] == 1.0
    assert fingerprints.compare_edited(documents(spark, [])).collect() == []


def test_a_moved_passage_keeps_its_anchors(spark):
    passage = prose(9, 60)
    df = spark.createDataFrame([(f"some other words in front {passage}", passage)], "a string, b string")
    for c in ("a", "b"):
        df = df.withColumn(f"{c}_anchors", fingerprints.anchors(F.col(c), kept=None))
    row = df.select("b_anchors", fingerprints.matches(F.col("a_anchors"), F.col("b_anchors")).alias("m")).first()
    assert len(row["b_anchors"]) == len(anchors(passage, None)) > 20
    # 1 + 2 + 2 + 1 + 2 fragments in front; a few anchors may have an earlier place there
    assert sum(m["start"] - m["other"] == 8 for m in row["m"]) == len(row["b_anchors"])


def test_no_python_in_the_plan(spark, tmp_path):
    path = str(tmp_path / "d")
    documents(spark, edge_rows()).write.parquet(path)
    plan = fingerprints.compare_edited(spark.read.parquet(path), block_rows=8)._jdf.queryExecution().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_the_query_takes_all_anchors(spark, tmp_path):
    from marketspark.llm.queries import QUERIES

    rows = edge_rows() + [(3000 + i, prose(i, 400) + " " + prose(i // 2, 300), "en", "a", 1) for i in range(12)]
    documents(spark, rows).write.parquet(str(tmp_path / "documents.parquet"))
    got = [tuple(r) for r in QUERIES["op13_fingerprints"](spark, str(tmp_path)).collect()]
    assert max(len(r[3].split()) for r in got) > 1000
    assert sorted(got, key=repr) == brute(rows, None)
