"""Language of a text by the ranks of its most frequent n-grams."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import kept, sliced, tidy

#: N-grams of a profile and of a text's own list.
PROFILE = 300
UNDECIDED = "und"
#: A training task hands its counts on after so many n-grams, which bounds its memory.
FLUSH = 2_000_000
EDGE = 1
_letters = None


def letters() -> np.ndarray:
    """For every code point whether it is a letter; made once a process."""
    global _letters
    if _letters is None:
        _letters = np.fromiter((chr(c).isalpha() for c in range(0x110000)), bool, 0x110000)
    return _letters


def ngrams(text: str | None) -> np.ndarray:
    """Codes of the letters, pairs and triples of the lower-cased words, in no order.

    A word is a run of letters; its edges count as a character, so that triples know them.
    """
    if not text:
        return np.empty(0, np.uint64)
    points = np.frombuffer(text.lower().encode("utf-32-le", "surrogatepass"), "<u4")
    mask = letters()[points]
    if not mask.any():
        return np.empty(0, np.uint64)
    keep = mask.copy()
    keep[1:] |= mask[:-1]
    a = np.where(mask, points, EDGE)[keep].astype(np.uint64)
    a = np.concatenate(([EDGE] if a[0] != EDGE else [], a, [EDGE] if a[-1] != EDGE else [])).astype(np.uint64)
    shift = np.uint64(21)
    two = (a[:-1] << shift) | a[1:]
    three = ((two[:-1] << shift) | a[2:])[a[1:-1] != EDGE]
    return np.concatenate((a[a != EDGE], two, three))


def counted(codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different codes of a sorted array and how often each is there."""
    starts = np.flatnonzero(np.concatenate(([True], codes[1:] != codes[:-1]))) if len(codes) else np.empty(0, np.int64)
    return codes[starts], np.diff(np.append(starts, len(codes)))


def ranked_ngrams(text: str | None, size: int = PROFILE) -> np.ndarray:
    """The text's most frequent n-grams, most frequent first, equal counts by code."""
    codes, counts = counted(np.sort(ngrams(text)))
    return codes[np.argsort(-counts, kind="stable")[:size]]


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting: dict[str, list[np.ndarray]] = {}

    def flush():
        for lang, parts in waiting.items():
            codes = np.concatenate(parts)
            codes.sort()
            codes, counts = counted(codes)
            yield pa.record_batch([pa.array([lang] * len(codes), pa.string()), pa.array(codes.astype(np.int64)), pa.array(counts.astype(np.int64))], ["lang", "code", "n"])
        waiting.clear()

    held = 0
    for batch in sliced(batches):
        for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text").to_pylist(), strict=True):
            codes = ngrams(text)
            if len(codes):
                waiting.setdefault(lang, []).append(codes)
                held += len(codes)
            if held > FLUSH:
                yield from flush()
                held = 0
    yield from flush()


def profiles(labelled: DataFrame, *, text: str = "text", lang: str = "lang", size: int = PROFILE) -> DataFrame:
    """lang, code, rank (from 0): the ``size`` most frequent n-grams of all texts of each language."""
    rows = labelled.where(F.col(lang).isNotNull() & F.col(text).isNotNull()).select(F.col(lang).alias("lang"), F.col(text).alias("text"))
    counts = rows.mapInArrow(tidy(_count_task), "lang string, code bigint, n bigint").groupBy("lang", "code").agg(F.sum("n").alias("n"))
    place = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("n"), "code"))
    # compared with the place itself, so that Spark keeps so many a task before the shuffle
    return counts.withColumn("place", place).where(F.col("place") <= size).select("lang", "code", (F.col("place") - 1).alias("rank"))


class Profiles:
    """All profiles as one sorted array of codes with a column of ranks for every language."""

    def __init__(self, rows: list[tuple[str, int, int]], size: int = PROFILE):
        self.size = size
        self.languages = sorted({r[0] for r in rows})
        self.codes = np.array(sorted({r[1] for r in rows}), np.uint64)
        self.ranks = np.full((len(self.codes), len(self.languages)), -1, np.int32)
        at, column = {c: i for i, c in enumerate(self.codes.tolist())}, {x: i for i, x in enumerate(self.languages)}
        for lang, code, rank in rows:
            self.ranks[at[code], column[lang]] = rank

    def predict(self, text: str | None) -> tuple[str, float]:
        """The language at the least out-of-place distance and 1 minus that distance's share of the most.

        An n-gram adds the difference of its two ranks, or the profile's size where the profile
        lacks it. Equal distances go to the first language by name.
        """
        own = ranked_ngrams(text, self.size)
        if not len(own) or not self.languages:
            return UNDECIDED, 0.0
        at = np.minimum(np.searchsorted(self.codes, own), len(self.codes) - 1)
        ranks = np.where((self.codes[at] == own)[:, None], self.ranks[at], -1)
        apart = np.where(ranks < 0, self.size, np.abs(ranks - np.arange(len(own))[:, None])).sum(axis=0)
        best = int(apart.argmin())
        return self.languages[best], float(1.0 - apart[best] / (self.size * len(own)))


def identify(rows: DataFrame, learned: DataFrame, *, text: str = "text", size: int = PROFILE) -> DataFrame:
    """``rows`` as a struct column ``row``, with lang_pred, score, and whether the text has a letter.

    The profiles go to every task: ``size`` rows a language, read from the written table. A text
    that is null or has no letter is ``und`` with score 0. Any other columns travel in the struct.
    """
    model = Profiles([tuple(r) for r in learned.select("lang", "code", "rank").collect()], size)
    shared = rows.sparkSession.sparkContext.broadcast(model)
    inner = rows.select(F.struct("*").alias("row"))
    schema = inner.select("row", F.lit("").alias("lang_pred"), F.lit(0.0).alias("score"), F.lit(True).alias("letters")).schema

    def task(batches):
        model = shared.value
        for batch in sliced(batches):
            given = batch.column("row").field(text).to_pylist()
            found = [model.predict(t) for t in given]
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array([f[0] for f in found], pa.string()), pa.array([f[1] for f in found], pa.float64()),
                 pa.array([any(map(str.isalpha, t or "")) for t in given], pa.bool_())],
                ["row", "lang_pred", "score", "letters"],
            )

    return inner.mapInArrow(tidy(task), schema)


def held_out(key: Column, folds: int = 4, fold: int = 2) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


def learn(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """Profiles from every row that is not held out, written once."""
    return kept(profiles(docs.where(~held_out(F.col(key))), text=text, lang=lang), "language-profiles")


def predict_languages(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """doc_id, held_out, lang_pred, score of every row; learns from the rows not held out.

    Null and empty texts and texts without a letter are ``und``, score 0; so is every text if no
    labelled text has a letter. Texts are read whole. Repeated rows are predicted alike and count as often as
    they are there. An empty table gives no rows.
    """
    narrow = docs.select(F.col(key).alias("doc_id"), F.col(text).alias("text"))
    found = identify(narrow, learn(docs, key=key, text=text, lang=lang))
    return found.select(F.col("row.doc_id").alias("doc_id"), held_out(F.col("row.doc_id")).alias("held_out"), "lang_pred", "score")


def known_language(docs: DataFrame, *, key: str = "doc_id", text: str = "text", lang: str = "lang") -> DataFrame:
    """The rows of ``docs`` whose text has a letter, with the predicted language where ``lang`` is null.

    Rows without a letter are rejected, whether or not any language was learned; texts are read whole.
    Other values stay as they are, columns and their order too; repeated rows are kept or go alike, and an
    empty table gives no rows. Without a learned profile a null ``lang`` stays null.
    """
    found = identify(docs, learn(docs, key=key, text=text, lang=lang), text=text).where("letters")
    told = F.when(F.col("lang_pred") != UNDECIDED, F.col("lang_pred"))
    return found.select(*[F.coalesce(F.col(f"row.`{c}`"), told).alias(c) if c == lang else F.col(f"row.`{c}`") for c in docs.columns])
