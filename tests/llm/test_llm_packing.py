"""Packing: ids as the tokenizer gives them, every id once, sequences filled by the rule."""

import random
import zlib

import numpy as np
import pytest
from llm_cases import documents, edge_rows, prose
from tokenizers import Tokenizer

from marketspark.llm import packing
from marketspark.llm.common import tokenizer


@pytest.fixture(scope="module")
def plain():
    return Tokenizer.from_file(tokenizer())


def check(rows, pieces, plain, capacity=1024):
    ids = {}
    for r, found in zip(rows, plain.encode_batch([r[1] or "" for r in rows], add_special_tokens=False), strict=True):
        ids.setdefault(r[0], []).append(np.array([*found.ids, 0], "<u4"))
    covered = {}
    for p in pieces:
        own = ids[p["doc_id"]]
        assert any(
            len(x) == p["doc_tokens"] and zlib.crc32(x[p["start"]:p["start"] + p["length"]].tobytes()) == p["ids_crc32"] for x in own
        )
        covered[p["doc_id"]] = covered.get(p["doc_id"], 0) + p["length"]
    assert covered == {i: sum(map(len, x)) for i, x in ids.items()}
    sequences = {}
    for p in sorted(pieces, key=lambda p: (p["sequence_id"], p["offset"])):
        assert p["offset"] == sequences.get(p["sequence_id"], 0)
        assert p["length"] > 0
        sequences[p["sequence_id"]] = p["offset"] + p["length"]
    assert all(n == capacity or n < capacity and n & (n - 1) == 0 for n in sequences.values())


@pytest.mark.parametrize("parts", [1, 4])
def test_every_id_once_and_no_padding(spark, plain, parts):
    rows = edge_rows() + [(3000 + i, prose(i, 1 + i * 7 % 900), None, None, None) for i in range(200)]
    pieces = packing.pack(documents(spark, rows, extra=True).repartition(parts), tokenizer=tokenizer()).collect()
    check(rows, pieces, plain)


def test_small_sequences_and_no_documents(spark, plain):
    rows = edge_rows()
    check(rows, packing.pack(documents(spark, rows), tokenizer=tokenizer(), capacity=16).collect(), plain, 16)
    assert packing.pack(documents(spark, []), tokenizer=tokenizer()).count() == 0
    with pytest.raises(ValueError):
        packing.pack(documents(spark, rows), tokenizer=tokenizer(), capacity=100)


def test_pieces_give_the_ids_of_whole_texts(plain):
    rng = random.Random(3)
    alphabet = ["a", "B", "é", "ß", "1", "23", " ", " ", "  ", "\n", "\t", "\xa0", "\u2003", "\x1c", "\x85", "'s", "'LL", "don't", ".", "!?", "|", "日本", "😀", "\u0301", "²",
                "<|endoftext|>", "x" * 80, "\r\n", "\u200b", "\x00", "٣", "Ⅷ"]
    texts = ["".join(rng.choice(alphabet) for _ in range(rng.randrange(0, 40))) for _ in range(4000)]
    expected = [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    own = packing.Encoder(tokenizer())
    for _ in range(2):
        got = [np.frombuffer(x, "<u4").tolist() for x in own.encode(texts)]
        assert got == expected


def test_placement_leaves_the_least_sum_of_squares():
    rng = random.Random(1)
    packer = packing.Packer(64, 0)
    for doc in range(400):
        size = rng.randrange(1, 64)
        counts = packer.levels.copy()
        level = packer.level_for(size)

        def squares(h):
            after = counts.copy()
            if h:
                after[h] -= 1
            if h + size < 64:
                after[h + size] += 1
            return int((after.astype(object) ** 2).sum())

        options = [h for h in range(64 - size + 1) if h == 0 or counts[h]]
        assert squares(level) == min(squares(h) for h in options)
        packer.add(doc, np.zeros(size, "<u4").tobytes())
        assert all(len(packer.open.get(h, [])) == packer.levels[h] for h in range(64))
    packer.finish()
    assert sum(r[2] for r in packer.rows) == sum({(r[0], r[4]): r[4] for r in packer.rows}.values())


def test_a_vocabulary_of_300000_words_is_encoded_once():
    own, encoded = packing.Encoder(tokenizer()), []
    parts = own.parts
    own.parts = lambda texts: encoded.extend(texts) or parts(texts)
    texts = [" ".join(f"w{i}" for i in range(at, at + 1000)) for at in range(0, 300_000, 1000)]
    first = [own.encode([t]) for t in texts]
    assert len(encoded) >= 300_000 - len(texts)
    encoded.clear()
    assert [own.encode([t]) for t in texts] == first and not encoded


def test_new_words_take_no_call_each(plain):
    """A text with many new words is one call of the encoder, and has the ids of the whole text."""
    rng = random.Random(5)
    own, calls = packing.Encoder(tokenizer()), []
    short = own.short
    own.short = lambda text: calls.append(text) or short(text)
    odd = ["", " ", "a\n\n b", "x<|endoftext|>y", "\x1c\u2003 don't", "日本 😀\u0301 ²"]
    texts = [" ".join("".join(rng.choices("abcdeé.,'1", k=rng.randrange(1, 12))) for _ in range(500)) for _ in range(20)] + odd
    got = [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)]
    assert got == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
    assert len(calls) <= len(texts)
    own.short = None
    assert [np.frombuffer(x, "<u4").tolist() for x in own.ids(texts)] == got


def test_equal_texts_are_encoded_once(plain, monkeypatch):
    own, given = packing.Encoder(tokenizer()), []
    short = own.short
    monkeypatch.setattr(own, "short", lambda text: given.append(text) or short(text))
    texts = [prose(1, 20), "", prose(1, 20), "a <|endoftext|> b", prose(2, 5), "", "a <|endoftext|> b"]
    found = own.ids(texts)
    assert sorted(given) == sorted({prose(1, 20), "", prose(2, 5)})
    assert [np.frombuffer(x, "<u4").tolist() for x in found] == [x.ids for x in plain.encode_batch(texts, add_special_tokens=False)]
