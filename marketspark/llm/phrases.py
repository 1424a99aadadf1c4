"""Collocations: frequent phrases by multikey three-way quicksort of suffixes, scored by their weakest cut."""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import forget, kept
from marketspark.llm.hashing import STEP, U, mix, texts

LONGEST = 5
LEAST = 100
TOP = 2000
PERCENT = 100
#: Suffixes that one sorting task is meant to hold.
TASK_ROWS = 1_000_000
#: Suffixes under one routing prefix from which it is opened to the next word, at least.
HOT_ROWS = 10_000
#: Bits of the filters that tasks are given: two megabytes each, whatever the vocabulary.
BITS = 1 << 24
#: Leading pairs are counted in 2**32 slots, by ranges of them.
RANGES = 1024
#: Words that a task gathers before it adds up equal ones, and bytes of a long text read at a time.
GATHERED = 1 << 21
PART = 1 << 20
#: Candidates of one language that a task ranks in the first of two steps, and parts of that step at most.
RANKED = 100_000
RANK_PARTS = 512

#: Fixed by the task: what ends a piece, and what stands between words (bytes).
ENDS = b".,;:!?\x0a\x0b\x0c\x0d"
BETWEEN = b" \t"

_ends = np.zeros(256, bool)
_ends[list(ENDS)] = True
_outside = _ends.copy()
_outside[list(BETWEEN)] = True
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32


def _runs(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, bytes and offsets of runs of texts; a long text in parts that end where a piece does."""
    for first, _, data, offsets in texts(column):
        if len(data) <= PART:
            yield first, data, offsets
            continue
        stops, at = np.flatnonzero(_ends[data]) + 1, 0  # then it is one text
        while at < len(data):
            after = np.searchsorted(stops, at + PART)
            stop = int(stops[after]) if after < len(stops) else len(data)
            yield first, data[at:stop], np.array([0, stop - at])
            at = stop


def word_places(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and text (its index) of every word, and whether the next word is in the same piece."""
    inside = ~_outside[data]
    starts, ends = inside.copy(), inside.copy()
    starts[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    bounds = offsets[(offsets > 0) & (offsets < len(data))]
    starts[bounds] = inside[bounds]
    ends[bounds - 1] = inside[bounds - 1]
    at, to = np.flatnonzero(starts), np.flatnonzero(ends) + 1
    text = np.searchsorted(offsets, at, side="right") - 1
    piece = np.cumsum(_ends[data], dtype=np.int32)[at]
    follows = np.zeros(len(at), bool)
    follows[:-1] = (piece[1:] == piece[:-1]) & (text[1:] == text[:-1])
    return at, to, text, follows


def word_hashes(data: np.ndarray, at: np.ndarray, to: np.ndarray, seeds: np.ndarray) -> np.ndarray:
    """A 64-bit hash of every lower-cased word and its seed (its language)."""
    size = to - at
    if not len(at):
        return np.empty(0, np.uint64)
    begins = np.cumsum(size) - size
    place = np.arange(int(size.sum())) - np.repeat(begins, size)
    values = (_lower[data[np.repeat(at, size) + place]].astype(np.uint64) + U(1)) * _powers(int(size.max()))[place]
    return mix(np.add.reduceat(values, begins) + size.astype(np.uint64) * STEP + seeds)


def _powers(n: int) -> np.ndarray:
    table = np.full(n, U(0x9E3779B97F4A7C15))
    table[0] = 1
    return np.cumprod(table)


def _language_seed(lang: str) -> int:
    data = np.frombuffer(lang.encode() or b"\x00", np.uint8)
    values = (data.astype(np.uint64) + U(1)) * _powers(len(data))
    return int(mix(mix(values.sum(keepdims=True) + U(len(lang)))[:1])[0])


class Gathered:
    """Words of text after text: ids (hash of language and word), and whether the next one goes on."""

    def __init__(self) -> None:
        self.seeds: dict[str, int] = {}
        self.clear()

    def clear(self) -> None:
        self.ids, self.follows, self.size = [], [], 0

    def read(self, batch: pa.RecordBatch, each=None) -> Iterator[None]:
        """Take in a batch; stops (yields) whenever GATHERED words are there."""
        langs = batch.column(0).to_pylist()
        for first, data, offsets in _runs(batch.column(1)):
            at, to, text, follows = word_places(data, offsets)
            known = [self.seeds.get(x) or self.seeds.setdefault(x, _language_seed(x)) for x in langs[first:first + len(offsets) - 1]]
            ids = word_hashes(data, at, to, np.array(known, np.uint64)[text] if len(at) else np.empty(0, np.uint64))
            if each is not None:
                each(first, data, at, to, text, ids)
            self.ids.append(ids)
            self.follows.append(follows)
            self.size += len(ids)
            if self.size >= GATHERED:
                yield

    def whole(self) -> tuple[np.ndarray, np.ndarray]:
        """What was gathered, which is let go."""
        found = np.concatenate([np.empty(0, np.uint64), *self.ids]), np.concatenate([np.empty(0, bool), *self.follows])
        self.clear()
        return found


def _words_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """id, lang, word and count of the different words of a task, gathered for some million words at a time."""
    gathered, spelled = Gathered(), {}

    def flush():
        ids, counts = np.unique(gathered.whole()[0], return_counts=True)
        told = [spelled[i] for i in ids.tolist()]
        spelled.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array(ids.view(np.int64)), pa.array([x for x, _ in told], pa.string()),
             pa.array([x for _, x in told], pa.binary()).cast(pa.string()), pa.array(counts.astype(np.int64))],
            names=["id", "lang", "word", "n"])

    for batch in batches:
        langs = batch.column(0).to_pylist()

        def spell(first, data, at, to, text, ids):
            own, where = np.unique(ids, return_index=True)
            low = _lower[data].tobytes()
            for i, k in zip(own.tolist(), where.tolist()):
                if i not in spelled:
                    spelled[i] = (langs[first + text[k]], low[at[k]:to[k]])

        for _ in gathered.read(batch, spell):
            yield flush()
    yield flush()


def _bits(rows: DataFrame, number: str) -> bytes:
    """The filter of the 64-bit numbers in ``rows``: BITS bits, whatever their number."""
    place = F.pmod(F.col(number), F.lit(BITS)) + 1
    parts = rows.select(place.alias("p")).groupBy(F.bitmap_bucket_number("p").alias("b")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("m"))
    whole = bytearray(BITS // 8)
    for row in parts.collect():
        at = (row["b"] - 1) * len(row["m"])
        whole[at:at + len(row["m"])] = row["m"]
    return bytes(whole)


def _open(bits: bytes) -> np.ndarray:
    return np.unpackbits(np.frombuffer(bits, np.uint8), bitorder="little").view(bool)


def _among(numbers: np.ndarray, bits: np.ndarray) -> np.ndarray:
    return bits[(numbers & U(BITS - 1)).astype(np.int64)]


def _slots(ids: np.ndarray) -> np.ndarray:
    """The slot, of 2**32, of every word and the one after it."""
    return mix(ids[:-1] * STEP + ids[1:]) >> U(32)


def _linked(ids: np.ndarray, follows: np.ndarray, often: np.ndarray, pairs: np.ndarray | None) -> np.ndarray:
    """Whether a phrase may go on from a word to the next: both are frequent, and so is their slot."""
    linked = np.zeros(len(ids), bool)
    linked[:-1] = follows[:-1] & often[:-1] & often[1:]
    if pairs is not None:
        linked[:-1] &= _among(_slots(ids), pairs)
    return linked


def _pairs_task(frequent: bytes):
    """The slots of a task's pairs of frequent words, by range: ascending steps, their bytes by place, packed."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, gathered = _open(frequent), Gathered()

        def flush():
            ids, follows = gathered.whole()
            linked = _linked(ids, follows, _among(ids, known), None)
            slots = np.sort(_slots(ids)[linked[:-1]])
            ends = np.searchsorted(slots, np.arange(RANGES + 1, dtype=np.uint64) * U((1 << 32) // RANGES))
            parts = [i for i in range(RANGES) if ends[i] < ends[i + 1]]
            packed = []
            for i in parts:
                steps = np.diff(slots[ends[i]:ends[i + 1]], prepend=U(i * ((1 << 32) // RANGES))).astype("<u4")
                packed.append(zlib.compress(steps.view(np.uint8).reshape(-1, 4).T.tobytes(), 1))
            return pa.RecordBatch.from_arrays([pa.array(parts, pa.int32()), pa.array(packed, pa.binary())], names=["part", "steps"])

        for batch in batches:
            for _ in gathered.read(batch):
                yield flush()
        yield flush()

    return task


def _full_slots_task(least: int):
    """The slots that ``least`` pairs or more fall into; rows come by range."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own, counts = None, None

        def full():
            found = np.flatnonzero(counts >= least) + own * len(counts) if own is not None else np.empty(0, np.int64)
            return pa.RecordBatch.from_arrays([pa.array(found.astype(np.int64))], names=["slot"])

        for batch in batches:
            for part, packed in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                if part != own:
                    yield full()
                    own, counts = part, np.zeros((1 << 32) // RANGES, np.int32)
                steps = np.frombuffer(zlib.decompress(packed), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
                at, n = np.unique(np.cumsum(steps, dtype=np.int64), return_counts=True)
                counts[at] = np.minimum(counts[at] + n, least)
        yield full()

    return task


def _prefix_hash(columns: list[np.ndarray]) -> np.ndarray:
    found = columns[0].copy()
    for column in columns[1:]:
        found = mix(found * STEP + column)
    return found


def _suffixes_task(told: Broadcast, level: int | None, longest: int):
    """Suffixes of 2 to ``longest`` words, cut before a rare word or pair; equal ones of a task are one with a count.

    ``told`` has the filters of frequent words and pairs, and the opened prefixes by their length. With a
    ``level``: the first so many words of suffixes under an opened prefix one word shorter, with the
    number of different suffixes and of all. Without: suffixes that go on beyond the words they are routed by,
    ``routed`` of them, and how often each is there.
    """

    def names() -> list[str]:
        return [f"w{i + 1}" for i in range(level or longest)]

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        frequent, pairs, opened = told.value
        known, full, gathered, tables = _open(frequent), _open(pairs), Gathered(), []
        for prefixes in opened:
            hashes = _prefix_hash(list(prefixes))
            order = np.argsort(hashes)
            tables.append((hashes[order], prefixes[:, order]))

        def different():
            """Words (a row a depth) and count of every different suffix."""
            ids, follows = gathered.whole()
            linked = _linked(ids, follows, _among(ids, known), full)
            at = np.flatnonzero(linked)
            columns, goes = [ids[at]], np.ones(len(at), bool)
            for d in range(1, longest):
                # a linked word has one after it, so the places stay within the words
                goes = goes & linked[np.minimum(at + d - 1, len(ids) - 1)]
                columns.append(np.where(goes, ids[np.minimum(at + d, len(ids) - 1)], U(0)))
            _, where, n = np.unique(_prefix_hash(columns), return_index=True, return_counts=True)
            return np.stack([c[where] for c in columns]), n.astype(np.int64)

        def flush():
            words, n = different()
            routed, still = np.ones(len(n), np.int32), np.ones(len(n), bool)
            for depth, (hashes, prefixes) in enumerate(tables, 1):
                at = np.minimum(np.searchsorted(hashes, _prefix_hash(list(words[:depth]))), len(hashes) - 1)
                still = still & (words[:depth] == prefixes[:, at]).all(axis=0)
                routed += still
            if level is None:
                keep = ((words != 0).sum(axis=0) > routed) & (routed < longest)
                columns, rest = words[:, keep], [routed[keep], n[keep]]
            else:
                under = np.flatnonzero(still & (words[level - 1] != 0))
                _, first, of = np.unique(_prefix_hash(list(words[:level, under])), return_index=True, return_inverse=True)
                columns = words[:level, under[first]]
                rest = [np.bincount(of, minlength=len(first)).astype(np.int64), np.bincount(of, n[under], len(first)).astype(np.int64)]
            return pa.RecordBatch.from_arrays([*[pa.array(c.view(np.int64)) for c in columns], *map(pa.array, rest)],
                                              names=[*names(), "routed" if level is None else "rows", "n"])

        for batch in batches:
            for _ in gathered.read(batch):
                yield flush()
        yield flush()

    return task


def frequent_prefixes(words: np.ndarray, counts: np.ndarray, least: int) -> list[tuple[int, int, int]]:
    """(a row, a length, how often) of every prefix that ``counts`` has ``least`` times or more.

    ``words`` has a row a depth and a column a suffix; 0 follows the last word. Multikey quicksort of
    pointers: a partition is divided by the word at its depth into less, equal and more; the equal
    part's size is the count of its prefix, and it goes on at the next depth. A partition that
    holds fewer than ``least`` suffixes is left as it is.
    """
    found = []
    waiting = [(np.arange(words.shape[1]), 0)]
    while waiting:
        at, depth = waiting.pop()
        key = words[depth][at]
        pivot = sorted((key[0], key[len(key) // 2], key[-1]))[1]
        equal = key == pivot
        if not equal.all():
            for part in (at[key < pivot], at[key > pivot]):
                if len(part) and counts[part].sum() >= least:
                    waiting.append((part, depth))
            at = at[equal]
        if pivot:
            n = int(counts[at].sum())
            if n >= least:
                found.append((int(at[0]), depth + 1, n))
                if depth + 1 < len(words):
                    waiting.append((at, depth + 1))
    return found


def _sort_task(longest: int, least: int):
    """Frequent phrases, longer than what their suffixes were routed by, of all suffixes of one task."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        whole = list(batches)
        if not whole:
            return
        rows = pa.Table.from_batches(whole)
        if not rows.num_rows:
            return
        words = np.stack([rows.column(i).to_numpy().view(np.uint64) for i in range(longest)])
        routed, counts = rows.column(longest).to_numpy(), rows.column(longest + 1).to_numpy()
        found = [(words[:n, at].view(np.int64).tolist(), c) for at, n, c in frequent_prefixes(words, counts, least) if n > routed[at]]
        for first in range(0, len(found), 10_000):
            some = found[first:first + 10_000]
            yield pa.RecordBatch.from_arrays([pa.array([w for w, _ in some], pa.list_(pa.int64())), pa.array([n for _, n in some], pa.int64())], names=["words", "f"])

    return task


def _route(longest: int) -> Column:
    """The words that a suffix is routed by, as one number."""
    route = F.col("w1")
    for k in range(2, longest + 1):
        route = F.when(F.col("routed") >= k, F.xxhash64(*[f"w{i + 1}" for i in range(k)])).otherwise(route)
    return route


def frequent_phrases(docs: DataFrame, vocabulary: DataFrame, *, longest: int, least: int, task_rows: int, hot_rows: int) -> DataFrame:
    """words (ids) and f of every phrase of up to ``longest`` words that is there ``least`` times.

    Leading pairs of words are counted in slots first; suffixes of a slot with fewer than ``least`` are left
    where they are. Which words and slots are frequent is told to the tasks by filters of one size; a
    false answer only lets a suffix through. The other suffixes go by their leading word to sorting tasks.

    A leading word that more suffixes share than a task should get is opened: its phrases of two words are
    counted, and its suffixes go by two words; and so on. At most (suffixes / limit) prefixes of a
    length are opened, the number of tasks at most, so every task is told them. Suffixes are
    made from the texts in every step: they are several times larger than these.
    """
    spark = docs.sparkSession
    often = vocabulary.where(F.col("n") >= least)
    frequent = _bits(often, "id")
    slots = docs.mapInArrow(_pairs_task(frequent), "part int, steps binary").repartition("part").sortWithinPartitions("part")
    pairs = _bits(slots.mapInArrow(_full_slots_task(least), "slot bigint"), "slot")
    found, opened, tables = [often.select(F.array("id").alias("words"), F.col("n").alias("f"))], [], []
    tasks = limit = None
    for level in range(1, longest + 1):
        told = spark.sparkContext.broadcast((frequent, pairs, opened))
        names = [f"w{i + 1}" for i in range(level)]
        counts = docs.mapInArrow(_suffixes_task(told, level, longest), ", ".join(f"{c} bigint" for c in [*names, "rows", "n"]))
        counts = counts.groupBy(*names).agg(F.sum("rows").alias("rows"), F.sum("n").alias("n"))
        counts = kept(counts.where(F.col("n") >= least) if level > 1 else counts, "phrase-level")
        tables.append(counts)
        if level == 1:
            rows = counts.agg(F.coalesce(F.sum("rows"), F.lit(0))).first()[0]
            tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // task_rows))
            limit = max(hot_rows, rows // tasks)
        else:
            found.append(counts.select(F.array(*names).alias("words"), F.col("n").alias("f")))
        crowded = counts.where(F.col("rows") > limit).select(*names).collect() if level < longest else []
        if not crowded:
            break
        opened = [*opened, np.array([tuple(r) for r in crowded], np.int64).T.reshape(level, -1).view(np.uint64)]
    told = spark.sparkContext.broadcast((frequent, pairs, opened))
    names = [f"w{i + 1}" for i in range(longest)]
    rows = docs.mapInArrow(_suffixes_task(told, None, longest), ", ".join([*[f"{c} bigint" for c in names], "routed int", "n bigint"]))
    found.append(rows.repartition(tasks, _route(longest)).mapInArrow(_sort_task(longest, least), "words array<bigint>, f bigint"))
    whole = found[0]
    for one in found[1:]:
        whole = whole.unionByName(one)
    phrases = kept(whole, "phrases")
    for table in tables:
        forget(table)
    return phrases


def _undominated(phrases: DataFrame, longest: int, percent: int) -> DataFrame:
    """words and a of the phrases of two words or more that no longer phrase stands for.

    A longer phrase that holds one and is frequent enough is reached by adding one word at a time,
    each step as frequent, so phrases of one word more tell.
    """
    size = F.size("words")
    longer = phrases.where(size >= 3)
    inside = longer.select(F.explode(F.array(F.slice("words", F.lit(1), size - 1), F.slice("words", F.lit(2), size - 1))).alias("inner"), "f")
    most = inside.groupBy("inner").agg(F.max("f").alias("most"))
    rows = phrases.where(size >= 2).join(most, F.col("words") == F.col("inner"), "left")
    return rows.where(F.coalesce(100 * F.col("most") < percent * F.col("f"), F.lit(True))).select("words", F.col("f").alias("a"))


def _spelled(rows: DataFrame, vocabulary: DataFrame) -> DataFrame:
    """``rows`` with lang and phrase."""
    each = rows.select("words", "a", F.posexplode("words").alias("at", "id"))
    told = each.join(vocabulary.select("id", "lang", "word"), "id")
    whole = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "word"))), lambda x: x["word"]), " ")
    return told.groupBy("words", "a").agg(F.min("lang").alias("lang"), whole.alias("phrase"))


def _scored(rows: DataFrame, phrases: DataFrame) -> DataFrame:
    """The lowest score of each phrase's cuts, with both sides' counts."""
    def exact(column: str, digits: int) -> Column:
        return F.col(column).cast(f"decimal({digits},0)")

    size = F.size("words")
    cuts = rows.select("*", F.explode(F.sequence(F.lit(1), size - 1)).alias("k"))
    cuts = cuts.withColumns({"first": F.slice("words", F.lit(1), F.col("k")), "rest": F.slice("words", F.col("k") + 1, size - F.col("k"))})
    for side, count in (("first", "l"), ("rest", "r")):
        cuts = cuts.join(phrases.select(F.col("words").alias(side), F.col("f").alias(count)), side)
    cuts = cuts.withColumns({"above": (exact("a", 18) * 1000).cast("decimal(20,0)") * exact("n", 18), "below": exact("l", 18) * exact("r", 18)})
    best = F.min(F.struct(F.expr("above div below").alias("score"), "k", "l", "r")).alias("b")
    return cuts.groupBy("words", "lang", "phrase", "a", "n").agg(best).select("lang", "phrase", "a", "b.l", "b.r", "n", "b.score")


def _first_of_each(rows: DataFrame, top: int) -> DataFrame:
    """The first ``top`` of each language, in two steps so that no task gets a language's whole list."""
    rows = kept(rows, "phrase-scores")
    order = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    parts = min(RANK_PARTS, rows.count() // RANKED + 1)
    if parts > 1:
        some = Window.partitionBy("lang", F.pmod(F.xxhash64("phrase"), F.lit(parts))).orderBy(*order)
        rows = rows.withColumn("rank", F.row_number().over(some)).where(F.col("rank") <= top)
    ranked = rows.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("bigint"))
    return ranked.where(F.col("rank") <= top).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def collocations(docs: DataFrame, *, text: str = "text", lang: str = "lang", longest: int = LONGEST, least: int = LEAST, top: int = TOP,
                 percent: int = PERCENT, task_rows: int = TASK_ROWS, hot_rows: int = HOT_ROWS) -> DataFrame:
    """lang, rank, phrase, a, l, r, n and score of the best phrases of each language.

    Texts, A to Z lower-cased, are cut into pieces at ``.,;:!?`` and line ends, pieces into words at
    blanks and tabs. Candidates are the phrases of 2 to ``longest`` words that a language's pieces
    have ``least`` times, overlaps included. The cut of a phrase into two parts (l and r times
    there) with the lowest floor(1000 a n / (l r)) gives its score, the leftmost of equals; n is the
    number of the language's words. Left out are phrases inside a longer one that is there
    ``percent`` hundredths as often. The first ``top`` by score, a (both falling) and phrase stay.

    Words are told apart by 64-bit hashes until they are spelled at the end; arithmetic is exact.

    Texts that are null, empty or have no word bring nothing; a null language is ``und``. Repeated rows
    count each. Very long texts are read in parts that end where a piece does. An empty table gives
    no rows. Other columns are not looked at.
    """
    rows = docs.select(F.coalesce(F.col(lang), F.lit("und")).alias("lang"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    words = rows.mapInArrow(_words_task, "id bigint, lang string, word string, n bigint")
    vocabulary = kept(words.groupBy("id", "lang", "word").agg(F.sum("n").alias("n")), "phrase-words")
    phrases = frequent_phrases(rows, vocabulary, longest=longest, least=least, task_rows=task_rows, hot_rows=hot_rows)
    often = vocabulary.where(F.col("n") >= least)
    sizes = vocabulary.groupBy("lang").agg(F.sum("n").alias("n"))
    candidates = _spelled(_undominated(phrases, longest, percent), often).join(sizes, "lang")
    return _first_of_each(_scored(candidates, phrases), top)
