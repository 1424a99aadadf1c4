"""Language by ranks of n-grams, against plain counting and on held-out texts."""

import random
import zlib
from collections import Counter

import pytest
from llm_cases import documents, edge_rows, prose, same_columns
from pyspark.sql import functions as F

from marketspark.llm import language

SPEECH = {
    "en": "the quick brown fox jumps over the lazy dog and then they went to the house with their friends because it was late".split(),
    "de": "der schnelle braune fuchs springt über den faulen hund und dann gingen sie nach hause weil es schon sehr spät geworden war".split(),
    "fr": "le renard brun rapide saute par dessus le chien paresseux et puis ils sont allés à la maison parce que il était déjà tard".split(),
}


def sentences(n=60):
    rng = random.Random(2)
    rows = []
    for i in range(n):
        lang = "en de fr".split()[i % 3]
        rows.append((10_000 + i, " ".join(rng.choice(SPEECH[lang]) for _ in range(rng.randrange(8, 60))), lang, "s", 1))
    return rows


def plain_grams(text):
    counts = Counter()
    word = ""
    for c in (text or "").lower() + " ":
        if c.isalpha():
            word += c
            continue
        if word:
            w = f"\x01{word}\x01"
            counts.update(word)
            counts.update(w[i:i + 2] for i in range(len(w) - 1))
            counts.update(w[i:i + 3] for i in range(len(w) - 2))
        word = ""
    return counts


def ranked(counts, size=300):
    def code(g):
        n = 0
        for c in g:
            n = n << 21 | ord(c)
        return n

    return sorted(counts, key=lambda g: (-counts[g], code(g)))[:size]


def test_predictions_against_plain_counting(spark):
    rows = sentences() + edge_rows()
    learned = {}
    for i, text, lang, *_ in rows:
        if lang is not None and text is not None and not (i is not None and zlib.crc32(str(i).encode()) % 4 == 2):
            learned.setdefault(lang, Counter()).update(plain_grams(text))
    profiles = {x: {g: k for k, g in enumerate(ranked(c))} for x, c in learned.items() if c}
    expected = []
    for i, text, *_ in rows:
        own = ranked(plain_grams(text))
        held = i is not None and zlib.crc32(str(i).encode()) % 4 == 2
        if not own:
            expected.append((i, held, "und", 0.0))
            continue
        apart = {x: sum(abs(p[g] - k) if g in p else 300 for k, g in enumerate(own)) for x, p in profiles.items()}
        best = min(sorted(apart), key=apart.get)
        expected.append((i, held, best, 1 - apart[best] / (300 * len(own))))
    found = language.predict_languages(documents(spark, rows, extra=True)).collect()
    assert sorted((repr(r["doc_id"]), r["held_out"], r["lang_pred"], round(r["score"], 9)) for r in found) == sorted(
        (repr(i), h, x, round(s, 9)) for i, h, x, s in expected
    )


def test_held_out_accuracy(spark):
    rows = sentences(300)
    truth = {r[0]: r[2] for r in rows}
    found = [r for r in language.predict_languages(documents(spark, rows)).collect() if r["held_out"]]
    assert len(found) > 30
    assert sum(truth[r["doc_id"]] == r["lang_pred"] for r in found) >= 0.98 * len(found)


def test_labels_are_no_input(spark):
    rows = sentences()
    held = [r for r in rows if zlib.crc32(str(r[0]).encode()) % 4 == 2]
    changed = [(*r[:2], "en", "other", 7) if r in held else r for r in rows]
    one, two = (
        {r["doc_id"]: tuple(r) for r in language.predict_languages(documents(spark, x)).collect()} for x in (rows, changed)
    )
    assert one == two


def test_stage_keeps_rows_with_a_letter(spark):
    rows = sentences() + edge_rows()
    df = documents(spark, rows, extra=True)
    left = language.known_language(df)
    assert same_columns(left, df)
    expected = [r for r in rows if any(c.isalpha() for c in r[1] or "")]
    found = [tuple(r)[:5] for r in left.collect()]
    assert all(r[2] for r in found), "a missing language is filled in"
    given = {(r[0], r[1]): r[2] for r in rows}
    found = [(*r[:2], r[2] and given[r[0], r[1]], *r[3:]) for r in found]
    assert sorted(found, key=repr) == sorted(expected, key=repr)


def test_nothing_to_learn_from(spark):
    assert language.predict_languages(documents(spark, [])).count() == 0
    found = language.predict_languages(documents(spark, [(1, "text", None, None, None)])).collect()
    assert [tuple(r) for r in found] == [(1, found[0]["held_out"], "und", 0.0)]


def test_small_flushes_give_the_same_profiles(spark, monkeypatch):
    df = documents(spark, sentences())
    whole = sorted(map(tuple, language.profiles(df).collect()))
    monkeypatch.setattr(language, "FLUSH", 50)
    assert sorted(map(tuple, language.profiles(df.repartition(3)).collect())) == whole


@pytest.mark.parametrize("text,n", [(None, 0), ("", 0), ("12 !", 0), ("ab", 7), ("a", 4)])
def test_ngrams_of_short_texts(text, n):
    assert len(language.ngrams(text)) == n


def test_texts_with_letters_stay_without_any_label(spark):
    rows = [(i, t, None, "a", 1) for i, t in enumerate(["plain words", "日本語", "Ünder", None, "", "12 34 ++ |", "3 x 4"])]
    df = documents(spark, rows, extra=True)
    left = language.known_language(df)
    assert same_columns(left, df)
    assert sorted(r["doc_id"] for r in left.collect()) == [0, 1, 2, 6]


def test_the_stage_fills_in_the_language_and_keeps_the_rest(spark):
    rows = [(i, prose(i, 80), "en", "a", 1) for i in range(20)] + [(100, prose(500, 80), None, "a", 1), (101, prose(501, 80), "xx", "b", 2), (102, "12 34", None, "a", 1)]
    df = documents(spark, rows).withColumn("row", F.lit("clash")).withColumn("a.b", F.lit(1))
    kept = language.known_language(df)
    assert kept.columns == df.columns and kept.dtypes == df.dtypes
    found = {r["doc_id"]: r for r in kept.collect()}
    assert set(found) == {r[0] for r in rows} - {102}
    assert found[100]["lang"] == "en" and found[101]["lang"] == "xx" and found[100]["row"] == "clash"
