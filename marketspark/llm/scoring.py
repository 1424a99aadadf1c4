"""Log probabilities of whole texts: a unigram base and a gated recurrent model."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm import gru
from marketspark.llm.common import forget, kept
from marketspark.llm.hashing import U, mix, texts, words

#: Most frequent words whose counts every task holds (16 bytes each); counts of others are joined.
HEAD = 1 << 19
#: The model's list has every word of the head that is there so often, and the most frequent ones anyway.
LEAST = 4
LISTED = 2048
#: Times that the replicas' weights are averaged; each round trains on its share of the texts.
ROUNDS = 3
#: Word hashes after which a counting task hands its counts on.
FLUSH = 4_000_000
#: Tokens that a replica reads at least, where there are more tasks than ``FEW``: its weights are then small beside its texts.
REPLICA = 4_000_000
FEW = 16
#: Tasks that average slices of the weights.
SUMMED = 64
#: The end of a text as a word: no word has this hash but by the chance of any two words.
END = int(mix(np.array([0xE4D], np.uint64))[0])


def held_out(key: Column, folds: int = 5, fold: int = 1) -> Column:
    return F.coalesce(F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(folds)) == fold, F.lit(False))


class Index:
    """Places of 64-bit keys in a list, -1 for others: a table with open addressing."""

    def __init__(self, keys: np.ndarray):
        bits = max(4, int(len(keys) * 3).bit_length())
        self.mask = U((1 << bits) - 1)
        self.keys, self.slots = keys, np.full(1 << bits, -1, np.int32)
        left, shift = np.arange(len(keys)), U(0)
        while len(left):
            at = ((keys[left] + shift) & self.mask).astype(np.int64)
            free = self.slots[at] < 0
            self.slots[at[free]] = left[free]
            left = left[self.slots[at] != left]
            shift += U(1)
        self.longest = int(shift)

    def find(self, wanted: np.ndarray) -> np.ndarray:
        found = np.full(len(wanted), -1, np.int64)
        left = np.arange(len(wanted))
        for shift in range(self.longest):
            slot = self.slots[((wanted[left] + U(shift)) & self.mask).astype(np.int64)]
            left, slot = left[slot >= 0], slot[slot >= 0]
            same = self.keys[slot] == wanted[left]
            found[left[same]] = slot[same]
            left = left[~same]
            if not len(left):
                break
        return found


def _count_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    waiting, held = [], 0

    def counted():
        keys, n = np.unique(np.concatenate(waiting), return_counts=True)
        return pa.record_batch([pa.array(keys.view(np.int64)), pa.array(n.astype(np.int64))], ["word", "n"])

    for batch in batches:
        for first, end, data, offsets in texts(batch.column("text")):
            hashes, _ = words(data, offsets)
            waiting += [hashes, np.full(end - first, END, np.uint64)]
            held += len(hashes) + end - first
            if held >= FLUSH:
                yield counted()
                waiting, held = [], 0
    if held:
        yield counted()


def word_counts(docs: DataFrame, *, text: str = "text") -> DataFrame:
    """word (64-bit hash), n over all the texts, the end of each text counted as a word."""
    rows = docs.select(F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(_count_task, "word bigint, n bigint").groupBy("word").agg(F.sum("n").alias("n"))


class Model:
    """What every task needs: the frequent words, the totals, and the weights."""

    def __init__(self, head: np.ndarray, counts: np.ndarray, total: int, distinct: int, least: int = LEAST):
        self.head, self.counts, self.total, self.distinct = head, counts, total, distinct
        listed = max(min(LISTED, len(head)), int((counts >= least).sum()))
        ends = np.flatnonzero(head[:listed] == U(END))
        self.start = int(ends[0]) if len(ends) else listed
        others = float(total - counts[:listed].sum())
        #: Half a count for each word outside the list, and for one that was never seen.
        self.outside = others + 0.5 * (distinct - listed) + 0.5
        self.words = gru.Words(counts[:listed], self.outside)
        self.p = gru.initial(self.words)
        self._index = None

    def __getstate__(self):
        return {**self.__dict__, "_index": None}

    @property
    def index(self) -> Index:
        if self._index is None:
            self._index = Index(self.head)
        return self._index

    def ids(self, places: np.ndarray) -> np.ndarray:
        return np.where((places >= 0) & (places < self.words.size), places, self.words.size)

    def runs(self, column: pa.Array):
        """For run after run of texts: row, hashes with the end, and places in the head, of each text."""
        end = int(self.index.find(np.array([END], np.uint64))[0]) if len(self.head) else -1
        for first, last, data, offsets in texts(column):
            hashes, at = words(data, offsets)
            places = self.index.find(hashes) if len(self.head) else np.full(len(hashes), -1, np.int64)
            yield [
                (first + i, np.append(hashes[at[i]:at[i + 1]], U(END)), np.append(places[at[i]:at[i + 1]], end))
                for i in range(last - first)
            ]


def _train_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        trainer = gru.Trainer(model.p, model.words, model.start)
        for batch in batches:
            for run in model.runs(batch.column("text")):
                for _, _, places in run:
                    trainer.add(model.ids(places))
                trainer.run(False)
        trainer.run(True)
        if trainer.tokens:
            for number, (new, old) in enumerate(zip(gru.slices(trainer.p), gru.slices(model.p), strict=True)):
                change = (new - old).astype("<f2").tobytes()
                yield pa.record_batch([pa.array([number]), pa.array([trainer.tokens]), pa.array([change], pa.binary())], CHANGES)

    return task


CHANGES = ["slice", "tokens", "change"]


def _average_changes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The mean change of each weight over the replicas that changed it, by the tokens they read.

    A replica without a word says nothing about its weights.
    """
    sums: dict[int, list[np.ndarray]] = {}
    for rows in batches:
        for number, n, data in zip(*(rows[c] for c in CHANGES), strict=True):
            change = np.frombuffer(data, "<f2").astype(np.float64)
            total, tokens = sums.setdefault(number, [np.zeros(len(change)), np.zeros(len(change))])
            total += change * n
            tokens += (change != 0) * n
    for number, (total, tokens) in sums.items():
        yield pd.DataFrame({"slice": [number], "change": [(total / np.maximum(tokens, 1.0)).astype("<f4").tobytes()]})


def train(docs: DataFrame, *, key: str = "doc_id", text: str = "text", head: int = HEAD, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model fitted on all rows of ``docs``, and the written counts of all their words.

    In each round every task continues from the shared weights on its own texts of that round,
    each text being in one round by its key's hash; then the changes of the weights are averaged,
    weighted by the tokens seen. More texts mean more replicas. The list and with it the weights
    grow with the words that are there ``LEAST`` times, up to ``head``. The driver gets the
    frequent words and, part by part, one set of weights a round.
    """
    spark = docs.sparkSession
    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    counts = kept(word_counts(rows), "word-counts")
    total, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    top = counts.orderBy(F.desc("n"), "word").limit(head).toArrow()
    model = Model(top["word"].to_numpy().view(np.uint64), top["n"].to_numpy(), total, distinct)
    for part in range(rounds if total else 0):
        shared = spark.sparkContext.broadcast(model)
        own = rows.where(F.pmod(F.xxhash64(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))), F.lit(rounds)) == part).select("text")
        replicas = max(min(spark.sparkContext.defaultParallelism, FEW), total // rounds // REPLICA)
        changes = own.coalesce(replicas).mapInArrow(_train_task(shared), "slice bigint, tokens bigint, change binary")
        changes = changes.repartition(SUMMED, "slice").mapInPandas(_average_changes, "slice bigint, change binary")
        means = kept(changes, "mean-changes")
        views = list(gru.slices(model.p))
        for mean in means.toLocalIterator():  # a partition at a time: the driver never holds all changes beside the weights
            views[mean["slice"]] += np.frombuffer(mean["change"], "<f4")
        forget(means)
        shared.destroy()
    return model, counts


SCORED = "row bigint, doc_id bigint, n_tokens bigint, n_known bigint, base double, score double, word bigint, n bigint"


def _score_task(shared):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = shared.value
        number = TaskContext.get().partitionId() << 33
        spread = np.log(model.total + 0.5 * (model.distinct + 1)) if model.total else 0.0
        logs = np.append(np.log(model.counts + 0.5), 0.0)
        scorer = gru.Scorer(model.p, model.words, model.start)
        rows = []
        rare = []
        for batch in batches:
            ids = batch.column("doc_id").to_pylist()
            for run in model.runs(batch.column("text")):
                for row, hashes, places in run:
                    at = len(rows)
                    seen = places >= 0
                    n, known = len(places), int(seen.sum())
                    listed = model.ids(places)
                    outside = (listed == model.words.size) & seen
                    fixed = logs[places[outside]].sum() - outside.sum() * np.log(model.outside)
                    rows.append((number + at, ids[row], n, known, logs[places].sum() - known * spread, fixed))
                    scorer.add(at, listed)
                    if known < n:
                        word, times = np.unique(hashes[~seen], return_counts=True)
                        rare.append((np.full(len(word), number + at), word.view(np.int64), times))
                scorer.run(False)
            if rare:
                yield _rare(rare)
                rare = []
        scorer.run(True)
        if rows:
            columns = list(zip(*rows, strict=True))
            score = np.array(columns[5]) + scorer.sums[:len(rows)]
            none = pa.nulls(len(rows), pa.int64())
            yield pa.record_batch(
                [*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.float64()), pa.array(score), none, none], NAMES
            )

    return task


NAMES = ["row", "doc_id", "n_tokens", "n_known", "base", "score", "word", "n"]


def _rare(parts) -> pa.RecordBatch:
    row, word, n = (np.concatenate(c) for c in zip(*parts, strict=True))
    none, real = pa.nulls(len(row), pa.int64()), pa.nulls(len(row), pa.float64())
    return pa.record_batch([pa.array(row), none, none, none, real, real, pa.array(word), pa.array(n.astype(np.int64))], NAMES)


def score_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", learn: Column | None = None,
                    head: int = HEAD, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every row.

    Learns from the rows where ``learn`` is true, by default those not held out. Tokens are words,
    then one end a text. Both scores are base-10 logarithms of a text's probability; the model's
    adds up over the tokens, so it is that of the whole text, with the state carried from its first
    word to its end. The base gives a word (c + 0.5) / (N + 0.5 (V + 1)). Words outside the model's list
    have the probability of that class times their smoothed share of it; one never seen has half a
    count.

    Counts of words beyond the ``head`` most frequent are joined to the texts' own counts, summed
    before they are shuffled. Null and empty texts are the end alone. A null key counts as not held
    out. Repeated rows are learned and scored one by one. An empty table gives no rows; without
    training rows the probabilities are those of N = 0 and V = 0. Other columns are not looked at.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    chosen = docs.where(~held_out(F.col(key)) if learn is None else learn)
    model, counts = train(chosen, key=key, text=text, head=head, rounds=rounds)
    shared = docs.sparkSession.sparkContext.broadcast(model)
    scored = kept(rows.mapInArrow(_score_task(shared), SCORED), "scored")
    rare = scored.where("word is not null").select("row", "word", "n")
    rare = rare.join(counts.withColumnRenamed("n", "c"), "word", "left")
    rare = rare.groupBy("row").agg(
        F.sum("n").alias("rare"), F.sum(F.when(F.col("c").isNotNull(), F.col("n")).otherwise(0)).alias("rare_known"),
        F.sum(F.col("n") * F.log(F.coalesce(F.col("c"), F.lit(0)) + 0.5)).alias("logs"),
    )
    spread = float(np.log(model.total + 0.5 * (model.distinct + 1)))
    outside = float(np.log(model.outside))
    ten = float(np.log(10.0))
    joined = scored.where("word is null").drop("word", "n").join(rare, "row", "left").fillna(0, ["rare", "rare_known"]).fillna(0.0, ["logs"])
    return joined.select(
        "doc_id", held_out(F.col("doc_id")).alias("held_out"), "n_tokens", (F.col("n_known") + F.col("rare_known")).alias("n_known"),
        F.lit(model.total).cast("bigint").alias("train_tokens"),
        ((F.col("base") + F.col("logs") - F.col("rare") * spread) / ten).alias("base_score"),
        ((F.col("score") + F.col("logs") - F.col("rare") * outside) / ten).alias("score"),
    )
