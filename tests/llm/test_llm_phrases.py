"""Collocations against plain counting, with prefixes opened at every depth."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from llm_cases import documents, edge_rows

from marketspark.llm import phrases

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least, top, percent=100, longest=5):
    count, total = {}, Counter()
    for row in rows:
        lang = "und" if row[2] is None else row[2]
        for piece in re.split(r"[.,;:!?\x0a-\x0d]", (row[1] or "").translate(LOWER)):
            words = re.findall(r"[^\x20\x09]+", piece)
            total[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    key = (lang, tuple(words[i:i + size]))
                    count[key] = count.get(key, 0) + 1
    found = {k: n for k, n in count.items() if n >= least}

    def inside(short, long):
        return any(long[i:i + len(short)] == short for i in range(len(long) - len(short) + 1))

    out = {}
    for (lang, words), a in found.items():
        if len(words) < 2 or any(x == lang and len(w) > len(words) and 100 * n >= percent * a and inside(words, w) for (x, w), n in found.items()):
            continue
        n = total[lang]
        cuts = [(1000 * a * n // (found[lang, words[:k]] * found[lang, words[k:]]), k) for k in range(1, len(words))]
        score, k = min(cuts)
        out.setdefault(lang, []).append((-score, -a, " ".join(words).encode(), found[lang, words[:k]], found[lang, words[k:]], n))
    return sorted((lang, i + 1, p.decode(), -a, left, right, n, -score)
                  for lang, rows in out.items() for i, (score, a, p, left, right, n) in enumerate(sorted(rows)[:top]))


def cases():
    rng = random.Random(5)
    words = ["the", "of", "The", "über", "x1", "naïve", "to", "日本"]
    rows = [(i, "".join(rng.choice(words) + rng.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b"]) for _ in range(rng.randrange(60))),
             rng.choice(["en", "en", "de", None, "und"]), "a", 1) for i in range(120)]
    line = "one very common line of six words"
    return edge_rows() + rows + [(2000 + i, f"{line} {rng.choice(words)}\n{line}", "en", "a", 1) for i in range(60)]


@pytest.mark.parametrize("hot_rows", [1, 40, 10_000])
def test_phrases_against_counting(spark, hot_rows):
    rows = cases()
    got = phrases.collocations(documents(spark, rows, extra=True).repartition(5), least=7, top=90, task_rows=300 if hot_rows < 10_000 else 1_000_000, hot_rows=hot_rows)
    assert got.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 7, 90)


def test_shares_below_the_whole_and_ranking_in_parts(spark, monkeypatch):
    monkeypatch.setattr(phrases, "RANKED", 50)
    rows = cases()
    got = phrases.collocations(documents(spark, rows), least=5, top=20, percent=60, longest=4)
    assert sorted(tuple(r) for r in got.collect()) == brute(rows, 5, 20, percent=60, longest=4)


def test_words_gathered_in_small_lots_and_long_texts_in_parts(spark, monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(phrases, "GATHERED", 40)
    monkeypatch.setattr(phrases, "PART", 50)
    texts = ["a b c. " * 40, None, "", "no end at all " * 20, ". , !"]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 5), pa.array(texts)], names=["lang", "text"])
    counts = Counter()
    for part in phrases._words_task(iter([batch])):
        for row in part.to_pylist():
            counts[row["lang"], row["word"]] += row["n"]
    assert counts == {("en", "a"): 40, ("en", "b"): 40, ("en", "c"): 40, ("en", "no"): 20, ("en", "end"): 20, ("en", "at"): 20, ("en", "all"): 20}


def test_an_empty_table_and_one_without_words(spark):
    for rows in ([], [(1, None, None, None, None), (2, " . ", "en", "a", 1)]):
        assert phrases.collocations(documents(spark, rows)).collect() == []


def test_partitions_against_counting():
    rng = np.random.default_rng(3)
    for _ in range(50):
        n = int(rng.integers(1, 200))
        words = rng.integers(0, 4, (4, n)).astype(np.uint64)
        for d in range(1, 4):
            words[d][words[d - 1] == 0] = 0
        counts = rng.integers(1, 4, n)
        want = Counter()
        for i in range(n):
            for d in range(1, 5):
                if words[d - 1, i]:
                    want[tuple(words[:d, i].tolist())] += int(counts[i])
        got = {tuple(words[:d, at].tolist()): c for at, d, c in phrases.frequent_prefixes(words, counts, 9)}
        assert got == {k: c for k, c in want.items() if c >= 9}
