"""Small documents with everything that may go wrong, and rows with clashing extra columns."""

import random

from pyspark.sql import functions as F

SCHEMA = "doc_id bigint, text string, lang string, source string, n_chars bigint"
#: Names that the operators use inside.
EXTRA = ["size", "row", "score", "component", "rep", "label", "g", "_row", "_id", "copies", "lang_pred", "word", "token", "b1", "kept", "bucket"]
WORDS = "the of and to in is that for it was on are as with his they at be this from have or by one had not but what all were".split()


def prose(seed, n):
    rng = random.Random(seed)
    return " ".join(rng.choice(WORDS) + rng.choice(["", "", "er", "ing", "x"]) for _ in range(n))


def edge_rows():
    long = prose(1, 30_000)
    base = prose(2, 120)
    near = base.replace("the", "teh", 1)
    rows = [
        (0, base, "en", "a", 1), (1, base, "en", "a", 1), (2, near, "en", None, None), (3, near, None, "b", 3),
        (4, None, "en", "b", None), (5, "", "en", "b", 0), (6, " \t\n ", "fr", "c", 4), (7, "12 34 ++ |", "fr", "c", 9),
        (8, long, "en", "a", len(long)), (9, long + " and more", "en", "c", None), (10, "one two", "en", "a", 7),
        (11, "One TWO", "en", "b", 7), (12, "Äpfel über Öl <|endoftext|> done", "de", "b", 5), (13, base + "\n" + prose(3, 60), "en", "a", 5),
        (14, "\n".join(["same line here"] * 12), "en", "b", 8), (None, base, "en", "a", 1), (None, None, None, None, None),
        (0, base, "en", "a", 1), (15, "null\x00byte and 日本語 text here", "ja", "d", 3), (16, "x" * 300, "en", "d", 300),
    ]
    return rows + [(100 + i, prose(100 + i, 40 + i), "en", "ab"[i % 2], 1) for i in range(20)]


def documents(spark, rows, extra=False):
    df = spark.createDataFrame(rows, SCHEMA)
    if extra:
        df = df.withColumns({c: F.lit("clash") for c in EXTRA})
    return df


def by_id(rows, *columns):
    return sorted(((r["doc_id"] is None, r["doc_id"] or 0, *[r[c] for c in columns]) for r in rows), key=repr)


def same_columns(a, b):
    return [(f.name, f.dataType) for f in a.schema] == [(f.name, f.dataType) for f in b.schema]
