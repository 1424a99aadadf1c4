"""Near copies among texts: an inverted join of signature coordinates, confirmed on full sets."""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import forget, kept, tidy, unused
from marketspark.llm.graph import components
from marketspark.llm.hashing import U, mix, shingle_sets

#: Words of a shingle, and least share of common shingles in percent.
WORDS = 5
PERCENT = 80
#: Coordinates of a signature, and the greatest chance that a pair at the least share agrees in too few
#: of them to be confirmed.
COORDINATES = 64
MISSED = 1e-5
#: Coordinates that must agree at PERCENT.
MATCHES = 36
#: Counters by which coordinate values are put in order, the rarest first.
COUNTERS = 1 << 16
#: Rows and shingles of one side of a block of a posting list.
BLOCK = 2000
BLOCK_ITEMS = 1 << 21
#: Rows that a task hands on together.
HANDED = 10_000
#: Ids that are broadcast at most (8 bytes each).
SMALL_IDS = 2_000_000
#: Rows of the larger side that follow one copy of a hub's set.
SALT_ROWS = 500

_random = np.random.default_rng(20240607)
MULTIPLY = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64) * U(2) + U(1)
ADD = _random.integers(0, 1 << 63, COORDINATES, dtype=np.uint64)


def _signatures(n: int):
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids = batch.column("doc_id")
            for first, sets in shingle_sets(batch.column("text"), n):
                sizes = np.array([len(s) for s in sets], np.int64)
                low, high, marks = np.zeros(len(sets), np.int64), np.zeros(len(sets), np.int64), [None] * len(sets)
                some = np.flatnonzero(sizes)
                if len(some):
                    flat = np.concatenate([sets[i] for i in some])
                    starts = np.concatenate(([0], np.cumsum(sizes[some])[:-1]))
                    least = np.empty((len(some), COORDINATES), np.uint32)
                    for k in range(COORDINATES):
                        least[:, k] = mix(np.minimum.reduceat(flat * MULTIPLY[k] + ADD[k], starts)).astype(np.uint32)
                    for row, i in enumerate(some):
                        digest = hashlib.blake2b(sets[i].tobytes(), digest_size=16).digest()
                        low[i], high[i] = np.frombuffer(digest, np.int64)
                        marks[i] = least[row].tobytes()
                yield pa.record_batch(
                    [ids.slice(first, len(sets)), pa.array(sizes), pa.array(low), pa.array(high), pa.array(marks, pa.binary())],
                    ["doc_id", "n_shingles", "low", "high", "signature"],
                )

    return task


def signatures(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS) -> DataFrame:
    """doc_id, n_shingles, a 128-bit digest of the shingle set, and its signature (null if empty).

    Shingles are compared by 64-bit hashes of their words.
    """
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    return rows.mapInArrow(tidy(_signatures(words)), "doc_id bigint, n_shingles bigint, low bigint, high bigint, signature binary")


def _matrix(column) -> np.ndarray:
    return np.frombuffer(b"".join(column), np.uint32).reshape(-1, COORDINATES)


def _tokens(marks: np.ndarray) -> np.ndarray:
    """One number for each coordinate and value."""
    return mix(marks.astype(np.uint64) | (np.arange(COORDINATES, dtype=np.uint64) << U(32)))


def _count_tokens(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total = np.zeros(COUNTERS, np.int64)
    for batch in batches:
        for at in range(0, batch.num_rows, 4096):
            tokens = _tokens(_matrix(batch.column("signature").slice(at, 4096).to_pylist()))
            total += np.bincount((tokens % U(COUNTERS)).astype(np.int64).ravel(), minlength=COUNTERS)
    some = np.flatnonzero(total)
    yield pa.record_batch([pa.array(some), pa.array(total[some])], ["bucket", "n"])


def postings(reps: DataFrame, matches: int = MATCHES) -> DataFrame:
    """token, doc_id, score: every document under its COORDINATES - matches + 1 rarest coordinate values.

    Two signatures that agree in ``matches`` coordinates share one of these, whatever the order
    of values, as long as it is one order for all. Here it goes by a table of COUNTERS counts (a
    fixed size) and then by the value, so that values of common passages come last. The score adds up
    the counts of all values of a document: of a text and its copies it is highest for the text that
    most resemble.
    """
    counts = reps.mapInArrow(_count_tokens, "bucket bigint, n bigint").groupBy("bucket").agg(F.sum("n").alias("n"))
    table = np.zeros(COUNTERS, np.uint64)
    for bucket, n in counts.collect():
        table[bucket] = n
    shared = reps.sparkSession.sparkContext.broadcast(table)
    length = COORDINATES - matches + 1

    def task(batches):
        table = shared.value
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                tokens = _tokens(_matrix(part.column("signature").to_pylist()))
                seen = table[tokens % U(COUNTERS)]
                order = np.minimum(seen, U((1 << 24) - 1)) << U(40) | tokens >> U(24)
                score = np.repeat(seen.sum(axis=1).view(np.int64), length)
                first = np.argsort(order, axis=1, kind="stable")[:, :length]
                chosen = np.take_along_axis(tokens, first, axis=1)
                ids = np.repeat(part.column("doc_id").to_numpy(), length)
                yield pa.record_batch([pa.array(chosen.ravel().view(np.int64)), pa.array(ids), pa.array(score)], ["token", "doc_id", "score"])

    return reps.mapInArrow(task, "token bigint, doc_id bigint, score bigint")


def with_hubs(posted: DataFrame) -> DataFrame:
    """token, doc_id, hub of the lists that have several documents; the hub has the highest score."""
    best = F.max(F.struct("score", (-F.col("doc_id")).alias("id")))
    lists = posted.groupBy("token").agg(F.count(F.lit(1)).alias("n"), best.alias("best")).where("n > 1")
    return posted.select("token", "doc_id").join(lists.select("token", (-F.col("best.id")).alias("hub")), "token")


def _agree(matches: int):
    def task(batches):
        for batch in batches:
            for at in range(0, batch.num_rows, 4096):
                part = batch.slice(at, 4096)
                same = (_matrix(part.column("sa").to_pylist()) == _matrix(part.column("sb").to_pylist())).sum(axis=1) >= matches
                yield pa.record_batch([part.column("a"), part.column("b")], ["a", "b"]).filter(pa.array(same))

    return task


def agreeing(pairs: DataFrame, reps: DataFrame, matches: int = MATCHES) -> DataFrame:
    """The pairs (a, b) whose signatures agree in ``matches`` coordinates at least."""
    one = reps.select(F.col("doc_id").alias("a"), F.col("signature").alias("sa"))
    two = reps.select(F.col("doc_id").alias("b"), F.col("signature").alias("sb"))
    return pairs.join(two, "b").join(one, "a").select("a", "b", "sa", "sb").mapInArrow(_agree(matches), "a bigint, b bigint")


class Tile(NamedTuple):
    """Rows of two blocks of a list, in the order of set sizes and ids."""

    ids: np.ndarray
    names: np.ndarray
    sizes: np.ndarray
    blocks: np.ndarray
    marks: np.ndarray


def _read(batch: pa.RecordBatch | pa.Table) -> Tile:
    ids, names, sizes, blocks = (batch.column(c).to_numpy() for c in ("doc_id", "component", "n_shingles", "block"))
    return Tile(ids, names, sizes, blocks, _matrix(batch.column("signature").to_pylist()))


def _tiles(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[tuple[int, int, int], Tile]]:
    """Key (hub, low, high) and rows of every tile of a task, whose rows come in that order."""
    held, parts = None, []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys, rows = [batch.column(c).to_numpy() for c in ("hub", "low", "high")], _read(batch)
        begins = np.flatnonzero(np.concatenate(([True], np.logical_or.reduce([k[1:] != k[:-1] for k in keys]))))
        for a, b in zip(begins, np.append(begins[1:], batch.num_rows), strict=True):
            key = tuple(int(k[a]) for k in keys)
            if parts and key != held:
                yield held, Tile(*(c[0] if len(c) == 1 else np.concatenate(c) for c in zip(*parts, strict=True)))
                parts = []
            held = key
            parts.append(Tile(*(c[a:b] for c in rows)))
    if parts:
        yield held, Tile(*(c[0] if len(c) == 1 else np.concatenate(c) for c in zip(*parts, strict=True)))


def _near(rows: Tile, low: int, high: int, matches: int, percent: int) -> Iterator[tuple[int, np.ndarray]]:
    """For the rows of a tile each row and the later ones that agree with it.

    Only pairs across the two blocks, of different components, and of sets neither of which is too large for
    the other are looked at; a row is the same as one of a set of its size.
    """
    marks, names, sizes, right = rows.marks, rows.names, rows.sizes, rows.blocks == high
    ends = np.searchsorted(sizes * percent, sizes * 100, side="right")
    for i in range(len(sizes)):
        near = slice(i + 1, ends[i])
        hits = (marks[near] == marks[i]).sum(axis=1, dtype=np.uint8) >= matches
        if hits.any():
            hits &= (names[near] != names[i]) & ((low == high) | (right[near] != right[i]))
            yield i, np.flatnonzero(hits) + i + 1


def _met_task(matches: int, percent: int):
    """The rows of each tile that agree with another one; rows come by tile, size of the set and id."""
    def handed(found: list[tuple]) -> pa.RecordBatch:
        keys, ids, blocks = zip(*found, strict=True)
        keys = np.repeat(np.array(keys, np.int64), [len(x) for x in ids], axis=0)
        return pa.record_batch(
            [pa.array(keys[:, 0]), pa.array(keys[:, 1].astype(np.int32)), pa.array(keys[:, 2].astype(np.int32)),
             pa.array(np.concatenate(ids)), pa.array(np.concatenate(blocks))], ["hub", "low", "high", "doc_id", "block"])

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        found, held = [], 0
        for key, rows in _tiles(batches):
            met = np.zeros(len(rows.ids), bool)
            for i, others in _near(rows, *key[1:], matches, percent):
                met[others] = True
                met[i] |= len(others) > 0
            if met.any():
                found.append((key, rows.ids[met], rows.blocks[met]))
                held += len(found[-1][1])
            if held >= HANDED:
                yield handed(found)
                found, held = [], 0
        if found:
            yield handed(found)

    return task


def _link_task(matches: int, percent: int):
    """Links that put the rows of two blocks into their components, confirmed on the full sets.

    Rows that a link has brought together already are not compared again.
    """
    def task(key: tuple, table: pa.Table) -> pa.Table:
        low, high = key[1].as_py(), key[2].as_py()
        order = np.lexsort((table.column("doc_id").to_numpy(), table.column("n_shingles").to_numpy()))
        rows = Tile(*(c[order] for c in _read(table)))
        items = table.column("items").to_pylist()
        sets, ids = [np.frombuffer(items[i], np.uint64) for i in order], rows.ids
        _, root = np.unique(rows.names, return_inverse=True)
        found = []
        for i, others in _near(rows, low, high, matches, percent):
            for j in others:
                if root[i] == root[j]:
                    continue
                small, large = sets[i], sets[j]
                both = int((large[np.minimum(np.searchsorted(large, small), len(large) - 1)] == small).sum())
                if 100 * both >= percent * (len(small) + len(large) - both):
                    found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
                    root[root == root[j]] = root[i]
        a, b = zip(*found, strict=True) if found else ([], [])
        return pa.table([pa.array(a, pa.int64()), pa.array(b, pa.int64())], ["a", "b"])

    return task


def crossing(posted: DataFrame, reps: DataFrame, named: DataFrame, docs: DataFrame, *, key: str, text: str, words: int = WORDS,
             matches: int = MATCHES, percent: int = PERCENT, block: int = BLOCK, items: int = BLOCK_ITEMS) -> DataFrame:
    """Links (a, b) between different components that lists have in common, enough to join these.

    Lists with the same hub are one: the documents around one passage share many values, and a pair
    need not be met under each. Only lists with several components are looked at. A list is
    spread over blocks of about ``block`` documents and ``items`` shingles; every pair of blocks is a group of
    its own. It finds the documents that agree with another one; only these bring their sets, once to each
    pair of blocks, where the pairs are confirmed. No table of pairs is made.
    """
    members = posted.select("hub", "doc_id").distinct().join(named.select(F.col("node").alias("doc_id"), "component"), "doc_id", "left")
    members = members.withColumn("component", F.coalesce("component", "doc_id"))
    lists = members.groupBy("hub").agg(F.min("component").alias("least"), F.max("component").alias("most")).where("least <> most").select("hub")
    members = kept(members.join(lists, "hub").join(reps, "doc_id"), "near-members")
    sized = members.groupBy("hub").agg(F.greatest(F.ceil(F.count(F.lit(1)) / block), F.ceil(F.sum("n_shingles") / items)).cast("int").alias("blocks"))
    spread = members.join(sized, "hub").withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
    spread = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "hub", F.least("block", "other").alias("low"), F.greatest("block", "other").alias("high"),
        "doc_id", "component", "block", "n_shingles", "signature",
    )
    tile = ["hub", "low", "high"]
    tasks = int(spread.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # little data, much work: not to be merged into few tasks
    dealt = spread.repartition(tasks, *tile).sortWithinPartitions(*tile, "n_shingles", "doc_id")
    met = dealt.mapInArrow(tidy(_met_task(matches, percent)), "hub bigint, low int, high int, doc_id bigint, block int")
    met = kept(met, "near-met")
    sets = shingles_of(met.select("doc_id"), docs, key=key, text=text, words=words)
    marked = members.select("hub", F.col("doc_id").alias("_of"), "component", "n_shingles", "signature")
    brought = met.join(marked.withColumnRenamed("hub", "_hub"), (F.col("hub") == F.col("_hub")) & (F.col("doc_id") == F.col("_of"))).drop("_hub", "_of")
    brought = brought.join(sets, "doc_id").repartition(tasks, *tile)
    links = kept(brought.groupBy(*tile).applyInArrow(_link_task(matches, percent), "a bigint, b bigint").distinct(), "near-links")
    for table in (members, met, sets):
        forget(table)
    return links


def _sets(n: int):
    def task(batches):
        for batch in batches:
            ids = batch.column("doc_id")
            for first, sets in shingle_sets(batch.column("text"), n):
                yield pa.record_batch([ids.slice(first, len(sets)), pa.array([s.tobytes() for s in sets], pa.binary())], ["doc_id", "items"])

    return task


def shingles_of(ids: DataFrame, docs: DataFrame, *, key: str, text: str, words: int = WORDS) -> DataFrame:
    """doc_id and items, the sorted shingles, of the documents in ``ids``, made from their whole texts and written."""
    ids = kept(ids.select(F.col("doc_id").alias("_id")).distinct(), "near-ids")
    small = ids.count() <= SMALL_IDS
    rows = docs.select(F.col(key).cast("bigint").alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = rows.join(F.broadcast(ids) if small else ids, F.col("doc_id") == F.col("_id"), "left_semi")
    sets = kept(rows.mapInArrow(tidy(_sets(words)), "doc_id bigint, items binary").dropDuplicates(["doc_id"]), "near-sets")
    forget(ids)
    return sets


def _confirm(percent: int):
    def task(batches):
        hub, own = None, None
        for batch in batches:
            found_a, found_b = [], []
            for a, salt, b, items in zip(*(batch.column(c).to_pylist() for c in ("a", "salt", "b", "items")), strict=True):
                other = np.frombuffer(items, np.uint64)
                if b is None:
                    hub, own = (a, salt), other
                    continue
                if hub != (a, salt):
                    raise ValueError("a pair came without its hub's set")
                both = len(np.intersect1d(own, other, assume_unique=True))
                if 100 * both >= percent * (len(own) + len(other) - both):
                    found_a.append(a)
                    found_b.append(b)
            yield pa.record_batch([pa.array(found_a, pa.int64()), pa.array(found_b, pa.int64())], ["a", "b"])

    return task


def confirmed(pairs: DataFrame, docs: DataFrame, *, key: str, text: str, words: int = WORDS, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full shingle sets share ``percent`` of their union or more.

    The sets are made again from the whole texts of the documents in the pairs. Each pair brings
    the set of b to the set of a; the partners of one a are dealt over salts, with a copy of its
    set for each, and come in order behind it, so no group is gathered.
    """
    sets = shingles_of(pairs.select(F.explode(F.array("a", "b")).alias("doc_id")), docs, key=key, text=text, words=words)
    salts = pairs.groupBy("a").agg(F.ceil(F.count(F.lit(1)) / SALT_ROWS).cast("int").alias("salts"))
    salted = pairs.join(salts, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("salts")).cast("int"))
    partners = salted.join(sets, F.col("b") == F.col("doc_id")).select("a", "salt", "b", "items")
    hubs = salts.join(sets, F.col("a") == F.col("doc_id")).select(
        "a", F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.lit(None).cast("bigint").alias("b"), "items"
    )
    lined = hubs.unionByName(partners).repartition("a", "salt").sortWithinPartitions("a", "salt", F.asc_nulls_first("b"))
    links = kept(lined.mapInArrow(tidy(_confirm(percent)), "a bigint, b bigint"), "near-links")
    forget(sets)
    return links


def enough(percent: int) -> int:
    """Coordinates that must agree: the most with which a pair at ``percent`` is missed with a chance of MISSED at most.

    At 80 they are 36, and the chance is 4.2e-6. A share that no number of coordinates covers is refused.
    """
    share, below, matches = percent / 100, 0.0, 0
    while matches < COORDINATES:
        below += math.comb(COORDINATES, matches) * share**matches * (1 - share) ** (COORDINATES - matches)
        if below > MISSED:
            break
        matches += 1
    if not matches:
        raise ValueError(f"signatures of {COORDINATES} coordinates do not find pairs at {percent} percent")
    return matches


def near_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", words: int = WORDS, percent: int = PERCENT,
                   matches: int | None = None) -> DataFrame:
    """doc_id, n_shingles, component_id and kept of every row.

    Equal sets are one class from the start. Classes are posted under their rarest signature
    values; each list first compares its hub with the others, and then only pairs that are not yet
    in one component, so a large group of copies of a text costs about its size. Pairs that
    agree in enough coordinates (``matches``, by default those of ``enough``) are confirmed on their full
    sets, those of a list within the task that met them. The links' components decide; the least doc_id
    of each is kept.

    Null and empty texts, and texts without a word, have no shingle, link with nothing and are kept.
    A row without a key links with nothing and is kept, its component null. Repeated rows of one
    key are one document. An empty table gives no rows. Other columns are not looked at.
    """
    matches = enough(percent) if matches is None else matches
    marked = kept(signatures(docs, key=key, text=text, words=words), "near-signatures")
    linked = marked.where("n_shingles > 0 and doc_id is not null")
    classes = kept(linked.groupBy("low", "high").agg(F.min("doc_id").alias("rep")), "near-classes")
    reps = linked.join(classes, ["low", "high"]).where("doc_id = rep").select("doc_id", "n_shingles", "signature").dropDuplicates(["doc_id"])
    reps = kept(reps, "near-reps")
    every = kept(postings(reps, matches), "near-postings")
    posted = kept(with_hubs(every), "near-lists")
    forget(every)
    pairs = posted.where("doc_id <> hub").select(F.col("hub").alias("a"), F.col("doc_id").alias("b")).distinct()
    near = kept(agreeing(pairs, reps, matches), "near-pairs")
    links = confirmed(near, docs, key=key, text=text, words=words, percent=percent)
    forget(near)
    more = crossing(posted, reps, components(links), docs, key=key, text=text, words=words, matches=matches, percent=percent)
    for table in (posted, reps):
        forget(table)
    named = kept(components(links.unionByName(more)), "near-components")
    for table in (links, more):
        forget(table)
    named = named.select(F.col("node").alias("rep"), "component")
    members = classes.join(named, "rep", "left").select("low", "high", F.coalesce("component", "rep").alias("component"))
    return marked.join(members, ["low", "high"], "left").select(
        "doc_id", "n_shingles",
        F.when((F.col("n_shingles") > 0) & F.col("doc_id").isNotNull(), F.col("component")).otherwise(F.col("doc_id")).alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("doc_id") == F.col("component_id"), F.lit(True)))


def one_of_each(docs: DataFrame, *, key: str = "doc_id", text: str = "text", **settings) -> DataFrame:
    """The rows of ``docs`` that stay, unchanged: one document of each component.

    Of rows that repeat a key the one of least hash over its values stays. Rows without a key stay, and so do
    texts without a word; an empty table gives no rows. Columns keep their names, whatever they are.
    """
    verdicts = kept(near_documents(docs, key=key, text=text, **settings), "near-verdicts")
    name = unused(docs, "_gone")
    gone = verdicts.where(~F.col("kept")).select(F.col("doc_id").alias(name)).distinct()
    small = gone.count() <= SMALL_IDS
    rows = docs.join(F.broadcast(gone) if small else gone, F.col(key).cast("bigint") == F.col(name), "left_anti")
    repeated = verdicts.where("doc_id is not null").groupBy("doc_id").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    if repeated.isEmpty():
        return rows
    whole, place = F.xxhash64(F.to_json(F.struct(*[F.col(f"`{c}`") for c in docs.columns]))), unused(docs, "_place")
    first = F.row_number().over(Window.partitionBy(key).orderBy(whole))
    known = rows.where(F.col(key).isNotNull()).withColumn(place, first).where(F.col(place) == 1).drop(place)
    return known.unionByName(rows.where(F.col(key).isNull()))
