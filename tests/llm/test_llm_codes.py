"""Vector codes against plain Lloyd rounds that compare every part with every entry."""

import hashlib
import math
import random

import numpy as np
import pytest
from llm_cases import EXTRA
from pyspark.sql import functions as F

from marketspark.llm import codes

SCHEMA = "vec_id bigint, embedding array<double>, label string"


def brute(rows, parts, entries, rounds):
    good = [(i, [math.floor(256 * x) for x in v], label) for i, v, label in rows
            if v and all(x is not None and math.isfinite(x) for x in v)]
    ordered = sorted(good, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    start = [v for i, v, _ in ordered if i is not None][:entries]
    width = len(start[0]) // parts
    books = [[v[p * width:(p + 1) * width] for v in start] for p in range(parts)]

    def assign(v):
        out = []
        for p in range(parts):
            own = v[p * width:(p + 1) * width]
            out.append(min((sum((a - b) ** 2 for a, b in zip(own, c)), e) for e, c in enumerate(books[p])))
        return out

    for _ in range(rounds):
        members = {}
        for _, v, _ in good:
            for p, (_, e) in enumerate(assign(v)):
                members.setdefault((p, e), []).append(v[p * width:(p + 1) * width])
        for (p, e), m in members.items():
            books[p][e] = [sum(column) // len(m) for column in zip(*m)]
    digest = hashlib.sha256(",".join(str(x) for b in books for c in b for x in c).encode()).hexdigest()
    found = [(i, assign(v), label) for i, v, label in good]
    by_label = {}
    for _, a, label in found:
        by_label[label] = by_label.get(label, 0) + sum(d for d, _ in a)
    return sorted(((i, "".join(f"{e:02x}" for _, e in a), sum(d for d, _ in a), by_label[label], digest) for i, a, label in found), key=repr)


def sample(n, dims, spread):
    rng = random.Random(n)
    # few different values, so that distances tie and entries stay while others move
    return [(i, [rng.choice(spread) for _ in range(dims)], rng.choice(["a", "hot", "hot", None])) for i in range(n)]


@pytest.mark.parametrize("spread", [[-0.01, 0.0, 0.004, 0.01], [-3000.5, 17.0, 200000.25, 0.1]])
def test_codes_against_comparing_all(spark, spread):
    rows = sample(150, 8, spread) + [
        (900, None, "a"), (901, [], "a"), (902, [0.0] * 7 + [None], "a"), (903, [0.0] * 7 + [float("nan")], "a"),
        (904, [float("inf")] + [0.0] * 7, "a"), (None, [0.01] * 8, "a"), (5, [0.01] * 8, None), (7, sample(150, 8, spread)[7][1], "hot"),
    ]
    df = spark.createDataFrame(rows, SCHEMA).withColumns({c: F.lit("clash") for c in [*EXTRA, "v", "code", "error", "row_id"] if c != "label"})
    got = codes.code_vectors(df, parts=4, entries=16)
    assert got.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == brute(rows, 4, 16, 2)


def test_few_rows_other_lengths_and_an_empty_table(spark):
    rows = [(3, [0.5] * 4, "a"), (1, [0.25] * 4, None), (2, [1.0] * 6, "a"), (4, [1.0] * 5, "a"), (5, [1e9] * 4, "a")]
    got = codes.code_vectors(spark.createDataFrame(rows, SCHEMA), parts=2, entries=64).collect()
    assert sorted((r["vec_id"], r["code"], r["error"]) for r in got) == [(1, "0000", 0), (3, "0101", 0)]
    empty = codes.code_vectors(spark.createDataFrame([], SCHEMA))
    assert empty.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"] and not empty.collect()


def test_updates_equal_whole_comparisons():
    rng = np.random.default_rng(4)
    for _ in range(200):
        x = rng.integers(-3, 4, (60, 2))
        old = rng.integers(-3, 4, (9, 2))
        code, error = codes.nearest(x, old)
        new = old.copy()
        change = rng.random(9) < rng.random()
        new[change] = rng.integers(-3, 4, (int(change.sum()), 2))
        codes.reassign(x, code, error, new, (new != old).any(axis=1))
        want, distance = codes.nearest(x, new)
        assert (code == want).all() and (error == distance).all()


def test_large_numbers_stay_exact():
    x = np.array([[codes.LARGEST, -codes.LARGEST], [codes.LARGEST, 1 - codes.LARGEST]])
    entries = np.array([[-codes.LARGEST, codes.LARGEST], [codes.LARGEST, -codes.LARGEST]])
    assert codes.distances(x, entries).tolist() == [[2 * (2 * codes.LARGEST) ** 2, 0], [(2 * codes.LARGEST) ** 2 + (2 * codes.LARGEST - 1) ** 2, 1]]
