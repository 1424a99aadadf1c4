"""The recurrent model: gradients, one law for all texts, better than the base on held-out texts."""

import math
import re
import zlib
from collections import Counter

import numpy as np
import pandas as pd
import pytest
from llm_cases import documents, edge_rows, prose

from marketspark.llm import gru, scoring


def tokens(text):
    return [*re.findall(rb"[^\x20\x09-\x0d]+", (text or "").encode().lower()), "end"]


def is_held_out(i):
    return i is not None and zlib.crc32(str(i).encode()) % 5 == 1


@pytest.mark.parametrize("head", [1 << 19, 7])
def test_base_score_and_counts_against_brute_force(spark, head):
    rows = edge_rows()
    counts = Counter(t for r in rows if not is_held_out(r[0]) for t in tokens(r[1]))
    total, distinct = sum(counts.values()), len(counts)
    found = scoring.score_documents(documents(spark, rows, extra=True), head=head).collect()
    got = sorted((repr(r["doc_id"]), r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) for r in found)
    assert got == sorted((repr(r[0]), is_held_out(r[0]), len(tokens(r[1])), sum(counts[t] > 0 for t in tokens(r[1])), total) for r in rows)
    base = sorted(r["base_score"] for r in found)
    expected = sorted(sum(math.log10((counts[t] + 0.5) / (total + 0.5 * (distinct + 1))) for t in tokens(r[1])) for r in rows)
    assert base == pytest.approx(expected, rel=1e-9)
    assert all(r["score"] < 0 and math.isfinite(r["score"]) for r in found)


def test_no_documents_and_no_training_documents(spark):
    assert scoring.score_documents(documents(spark, [])).count() == 0
    held = next(i for i in range(100) if is_held_out(i))
    row = scoring.score_documents(documents(spark, [(held, "a b", None, None, None)])).first()
    assert (row["n_tokens"], row["n_known"], row["train_tokens"], row["base_score"]) == (3, 0, 0, 0.0)


def test_model_beats_the_base_on_held_out_texts(spark):
    """Texts in which each word nearly decides the next."""
    rng = np.random.default_rng(1)
    following = rng.permutation(40)
    rows = []
    for i in range(3000):
        word, text = rng.integers(40), []
        for _ in range(150):
            text.append(f"w{word}")
            word = following[word] if rng.random() < 0.9 else rng.integers(40)
        rows.append((i, " ".join(text), None, None, None))
    found = scoring.score_documents(documents(spark, rows)).toPandas()
    held = found[found.held_out]
    assert len(held) > 300
    assert held.score.sum() > 0.9 * held.base_score.sum()


def small():
    words = gru.Words(np.array([50, 40, 30, 20, 10, 5, 3]), 4.0, classes=3)
    p = {k: v.astype(np.float64) for k, v in gru.initial(words, hidden=5, seed=1).items()}
    rng = np.random.default_rng(0)
    return words, {k: v + rng.standard_normal(v.shape) * 0.3 for k, v in p.items()}


def test_gradients_against_differences():
    words, p = small()
    rng = np.random.default_rng(4)
    inputs, targets = rng.integers(0, 8, (6, 4)), rng.integers(0, 8, (6, 4))
    fresh = rng.random((6, 4)) < 0.2
    state = rng.standard_normal((4, 5))

    def loss():
        states, _, _ = gru.forward(p, inputs, fresh, state, False)
        return -gru.output(p, words, states.reshape(-1, 5).astype(np.float64), targets.ravel())[0].sum()

    states, _, saved = gru.forward(p, inputs, fresh, state, True)
    grads = {}
    _, d = gru.output(p, words, states.reshape(-1, 5).astype(np.float64), targets.ravel(), grads)
    gru.backward(p, inputs, fresh, saved, d.reshape(states.shape), grads)
    whole = np.zeros_like(p["embed"])
    whole[grads["embed"][0]] = grads["embed"][1]
    grads["embed"] = whole
    for name in p:
        for at in list(np.ndindex(p[name].shape))[:: max(1, p[name].size // 12)]:
            keep, step = p[name][at], 1e-3
            p[name][at] = keep + step
            up = loss()
            p[name][at] = keep - step
            down = loss()
            p[name][at] = keep
            assert grads[name][at] == pytest.approx((up - down) / (2 * step), abs=2e-2), (name, at)


def test_probabilities_of_the_next_word_add_up():
    words, p = small()
    state = np.random.default_rng(3).standard_normal((1, 5))
    total = sum(math.exp(gru.output(p, words, state.copy(), np.array([w]))[0][0]) for w in range(words.size + 1))
    assert total == pytest.approx(1.0, abs=1e-6)


def test_score_of_a_text_does_not_depend_on_its_neighbours():
    words, p = small()
    p = {k: v.astype(np.float32) for k, v in p.items()}
    rng = np.random.default_rng(7)
    texts = [rng.integers(0, 8, n) for n in (1, 3, 200, 17, 64, 65, 2)]

    def scores(order, streams, steps):
        scorer = gru.Scorer(p, words, 0, streams, steps)
        for i in order:
            scorer.add(i, texts[i])
            scorer.run(False)
        scorer.run(True)
        return scorer.sums[:len(texts)]

    alone = scores(range(len(texts)), 1, 1000)
    assert scores(reversed(range(len(texts))), 3, 16) == pytest.approx(alone, rel=1e-4)
    state, total = np.zeros((1, 5), np.float32), 0.0
    for k, word in enumerate(texts[3]):
        before = np.array([[0 if k == 0 else texts[3][k - 1]]])
        states, state, _ = gru.forward(p, before, np.array([[k == 0]]), state, False)
        total += gru.output(p, words, states.reshape(1, 5), np.array([word]))[0][0]
    assert alone[3] == pytest.approx(total, rel=1e-4)


def test_index_finds_what_is_there():
    keys = np.unique(np.random.default_rng(5).integers(0, 1 << 12, 900).astype(np.uint64) << np.uint64(20))
    index = scoring.Index(keys)
    assert (index.find(keys) == np.arange(len(keys))).all()
    assert (index.find(keys + np.uint64(1)) == -1).all()
    assert (scoring.Index(keys[:0]).find(keys) == -1).all()


def test_long_text_has_one_probability(spark):
    rows = [(i, prose(i, 30), None, None, None) for i in range(20)] + [(900, prose(5, 20_000), None, None, None)]
    found = {r["doc_id"]: r for r in scoring.score_documents(documents(spark, rows)).collect()}
    assert found[900]["n_tokens"] == 20_001
    assert found[900]["score"] > 1.05 * found[900]["base_score"]


def test_words_beyond_the_most_frequent_are_told_apart_by_context(spark):
    """5,000 equally frequent words, of which each decides the next."""
    n, rng = 5000, np.random.default_rng(2)
    order = rng.permutation(n)
    following = np.empty(n, np.int64)
    following[order] = np.roll(order, -1)
    rows = []
    for i in range(4000):
        word, text = rng.integers(n), []
        for _ in range(60):
            text.append(f"w{word}")
            word = following[word]
        rows.append((i, " ".join(text), None, None, None))
    docs = documents(spark, rows)
    model, _ = scoring.train(docs, rounds=1)
    assert model.words.size == n + 1
    assert model.words.classes >= 0.5 * n ** 0.5
    before = gru.initial(model.words)
    moved = (model.p["embed"][:-1] != before["embed"][:-1]).any(axis=1)
    assert moved.mean() > 0.99
    assert (model.p["ww"] != 0).any(axis=0).mean() > 0.99


def test_list_grows_with_the_counts_up_to_the_head():
    counts = np.sort(np.random.default_rng(3).integers(1, 9, 9000))[::-1]
    head = np.arange(9000, dtype=np.uint64)
    assert scoring.Model(head, counts, int(counts.sum()), 9000).words.size == (counts >= scoring.LEAST).sum() > scoring.LISTED
    assert scoring.Model(head[:50], counts[-50:], 50, 50).words.size == 50


def test_mean_change_is_over_the_replicas_that_changed_a_weight():
    rows = pd.DataFrame({"slice": [0, 0, 1], "tokens": [1, 3, 3], "change": [np.array(c, "<f2").tobytes() for c in ([1, 0, 2], [0, 0, 4], [5])]})
    found = {r["slice"].iloc[0]: np.frombuffer(r["change"].iloc[0], "<f4").tolist() for r in scoring._average_changes(iter([rows]))}
    assert found == {0: [1.0, 0.0, 3.5], 1: [5.0]}


def test_driver_holds_one_set_of_weights_and_little_beside(spark, monkeypatch):
    """Neither drawing the first weights nor taking in a round's changes needs a second whole set."""
    import tracemalloc

    monkeypatch.setattr(gru, "DRAWN", 1 << 10, raising=False)
    rows = [(i, " ".join(f"w{(i * 50 + k) % 60_000}" for k in range(200)), None, None, None) for i in range(6000)]
    docs = documents(spark, rows).repartition(2).cache()
    docs.count()
    tracemalloc.start()
    model, _ = scoring.train(docs, rounds=1)
    _, most = tracemalloc.get_traced_memory()
    tracemalloc.stop()
    docs.unpersist()
    assert model.words.size == 60_001
    assert most < 2.2 * sum(v.nbytes for v in model.p.values())


def test_first_weights_do_not_depend_on_how_many_are_drawn_at_a_time(monkeypatch):
    words = gru.Words(np.arange(50, 0, -1), 1.0)
    whole = gru.initial(words)
    rng = np.random.default_rng(3)
    assert (whole["embed"] == (rng.standard_normal((51, gru.HIDDEN)) * 0.1).astype(np.float32)).all()
    monkeypatch.setattr(gru, "DRAWN", 7)
    assert all((whole[k] == v).all() for k, v in gru.initial(words).items())


def grouped():
    """Two classes whose words are told apart at once, and three of groups of 4 words, the last one of 2."""
    words = gru.Words(np.array([50 - i for i in range(38)]), 4.0, classes=5, long=20, whole=3, group=4)
    p = {k: v.astype(np.float64) for k, v in gru.initial(words, hidden=5, seed=1).items()}
    rng = np.random.default_rng(0)
    return words, {k: v + rng.standard_normal(v.shape) * 0.3 for k, v in p.items()}


def test_a_long_list_has_groups_between_classes_and_words(monkeypatch):
    words, p = grouped()
    assert (words.whole, words.classes, words.first % 4) == (2, 5, words.columns % 4)
    assert words.columns > words.size and p["wg"].shape == (5, words.groups[-1])
    state = np.random.default_rng(3).standard_normal((1, 5))
    for block in (1 << 18, 1):
        monkeypatch.setattr(gru, "BLOCK", block)
        total = sum(math.exp(gru.output(p, words, state.copy(), np.array([w]))[0][0]) for w in range(words.size + 1))
        assert total == pytest.approx(1.0, abs=1e-6)
    first = gru.initial(words)
    logp, _ = gru.output(first, words, np.ones((39, gru.HIDDEN), np.float32), np.arange(39))
    counts = np.append(words.counts, 4.0)
    assert np.exp(logp) == pytest.approx(counts / counts.sum(), rel=1e-4)


@pytest.mark.parametrize("block", [1 << 18, 60])
def test_gradients_of_a_long_list_against_differences(monkeypatch, block):
    monkeypatch.setattr(gru, "BLOCK", block)
    monkeypatch.setattr(gru, "MANY", 2)
    words, p = grouped()
    rng = np.random.default_rng(4)
    states, targets = rng.standard_normal((200, 5)), rng.integers(0, 39, 200)
    targets[:30] = 37
    grads = {}
    _, d = gru.output(p, words, states, targets, grads)
    for name, values, found in [*((k, p[k], grads[k]) for k in ("wc", "bc", "ww", "bw", "wg", "bg")), ("states", states, d)]:
        for at in list(np.ndindex(values.shape))[:: max(1, values.size // 40)]:
            keep, step, both = values[at], 1e-4, []
            for values[at] in (keep + step, keep - step):
                both.append(-gru.output(p, words, states, targets)[0].sum())
            values[at] = keep
            assert found[at] == pytest.approx((both[0] - both[1]) / (2 * step), abs=1e-4), (name, at)


def test_time_of_an_output_does_not_grow_with_the_root_of_the_list():
    """Numbers worked out for a word: classes, then words or groups of its class, then words of its group."""
    rank = np.arange(1, 300_001)
    words = gru.Words((1e7 / rank).astype(np.int64), 1e5)
    share = words.counts / words.counts.sum()
    fan = np.append(np.diff(words.bounds[:words.whole + 1]), np.diff(words.groups) + words.group) if words.whole < words.classes else np.diff(words.bounds)
    assert words.classes + (share * fan[words.class_of[:-1]]).sum() < 250


def test_windows_do_not_depend_on_how_many_are_cut_at_a_time(monkeypatch):
    rng = np.random.default_rng(7)
    texts = [rng.integers(0, 8, n) for n in rng.integers(1, 300, 60)]

    def windows():
        streams, found = gru.Streams(0, 4, 16), []
        for i, ids in enumerate(texts):
            streams.add(i, ids)
            found += list(streams.windows(False)) if i % 20 == 19 else []
        return found + list(streams.windows(True))

    several = windows()
    monkeypatch.setattr(gru, "AHEAD", 1)
    alone = windows()
    assert len(several) == len(alone)
    assert all((x == y).all() for a, b in zip(several, alone, strict=True) for x, y in zip(a, b, strict=True))
