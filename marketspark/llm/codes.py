"""Product codes of vectors: Lloyd rounds that compare again only what may have changed."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import forget, kept

PARTS = 16
ENTRIES = 64
ROUNDS = 2
SCALE = 256.0
#: Components beyond this (as whole numbers) would let squared distances leave 64 bits.
LARGEST = 1 << 26
#: Rows of a batch that are compared with a whole codebook at a time.
ROWS = 8192
STATE = "row_id bigint, label_key string, v array<int>, code binary, error array<bigint>"


def whole_numbers(vector: Column) -> Column:
    """floor(256 * x) of every component; null if a component is null, not finite or beyond LARGEST."""
    def inside(x):
        return F.coalesce(~F.isnan(x) & (F.abs(x) < LARGEST / SCALE), F.lit(False))

    whole = F.transform(vector, lambda x: F.floor(x.cast("double") * SCALE).cast("int"))
    return F.when(F.forall(vector, inside), whole)


def distances(x: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Squared distance of every row of ``x`` to every entry, exact in 64-bit integers."""
    most = int(max(np.abs(x).max(initial=0), np.abs(entries).max(initial=0)))
    if 4 * most * most * max(1, x.shape[1]) < 1 << 53:  # then every sum is exact in doubles too
        a, b = x.astype(np.float64), entries.astype(np.float64)
        return ((a * a).sum(1)[:, None] - 2.0 * (a @ b.T) + (b * b).sum(1)).astype(np.int64)
    total = np.zeros((len(x), len(entries)), np.int64)
    for k in range(x.shape[1]):
        total += (x[:, k, None] - entries[None, :, k]) ** 2
    return total


def nearest(x: np.ndarray, entries: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Index of the nearest entry (the lower one of equals) and its distance."""
    found = distances(x, entries)
    code = found.argmin(1)
    return code, found[np.arange(len(x)), code]


def reassign(x: np.ndarray, code: np.ndarray, error: np.ndarray, entries: np.ndarray, moved: np.ndarray) -> None:
    """Bring ``code`` and ``error`` up to date after the entries ``moved`` (a mask) have changed.

    Where the assigned entry stayed, its stored distance is exact and least among all that stayed,
    so only moved entries can beat it: by a smaller distance, or by a lower index at the same one.
    Rows whose own entry moved are compared with all entries.
    """
    lost = moved[code]
    if lost.any():
        code[lost], error[lost] = nearest(x[lost], entries)
    at = np.flatnonzero(moved)
    if len(at) and not lost.all():
        stayed = np.flatnonzero(~lost)
        other, distance = nearest(x[stayed], entries[at])
        other = at[other]
        better = (distance < error[stayed]) | ((distance == error[stayed]) & (other < code[stayed]))
        code[stayed[better]], error[stayed[better]] = other[better], distance[better]


def _matrix(column: pa.Array, width: int, kind: type) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(kind).reshape(len(column), width)


def _codes(column: pa.Array, parts: int) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), parts).astype(np.int64)


def _assign_task(books: np.ndarray, moved: np.ndarray | None):
    """State rows with codes for ``books`` (part, entry, position); ``moved`` is None at the start."""
    parts, _, width = books.shape

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                x = _matrix(rows["v"], parts * width, np.int64).reshape(rows.num_rows, parts, width)
                if moved is None:
                    code = np.zeros((rows.num_rows, parts), np.int64)
                    error = np.zeros((rows.num_rows, parts), np.int64)
                else:
                    code, error = _codes(rows["code"], parts), _matrix(rows["error"], parts, np.int64)
                for p in range(parts):
                    if moved is None:
                        code[:, p], error[:, p] = nearest(x[:, p], books[p])
                    else:
                        reassign(x[:, p], code[:, p], error[:, p], books[p], moved[p])
                packed = code.astype(np.uint8)
                offsets = pa.array(np.arange(0, (rows.num_rows + 1) * parts, parts, dtype=np.int32))
                yield pa.RecordBatch.from_arrays(
                    [rows["row_id"], rows["label_key"], rows["v"], pa.array([r.tobytes() for r in packed], pa.binary()),
                     pa.ListArray.from_arrays(offsets, pa.array(error.ravel()))],
                    names=["row_id", "label_key", "v", "code", "error"])

    return task


def _sums_task(parts: int, entries: int, width: int):
    """One row a used entry and task: how many parts it has and their componentwise sums."""

    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count = np.zeros(parts * entries, np.int64)
        total = np.zeros((parts * entries, width), np.int64)
        for batch in batches:
            for first in range(0, batch.num_rows, ROWS):
                rows = batch.slice(first, ROWS)
                x = _matrix(rows["v"], parts * width, np.int64).reshape(rows.num_rows, parts, width)
                slot = _codes(rows["code"], parts) + np.arange(parts) * entries
                count += np.bincount(slot.ravel(), minlength=len(count))
                for k in range(width):  # a batch's sums stay below 2**53
                    total[:, k] += np.bincount(slot.ravel(), x[:, :, k].ravel().astype(np.float64), len(count)).astype(np.int64)
        used = np.flatnonzero(count)
        offsets = pa.array(np.arange(0, (len(used) + 1) * width, width, dtype=np.int32))
        yield pa.RecordBatch.from_arrays(
            [pa.array((used // entries).astype(np.int32)), pa.array((used % entries).astype(np.int32)), pa.array(count[used]),
             pa.ListArray.from_arrays(offsets, pa.array(total[used].ravel()))],
            names=["part", "entry", "n", "total"])

    return task


def _moved_books(state: DataFrame, books: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Every entry replaced by the floor of its parts' mean, and which entries that changed.

    The driver gets one row an entry: parts x entries x width numbers, whatever the input.
    """
    parts, entries, width = books.shape
    sums = state.select("v", "code").mapInArrow(_sums_task(parts, entries, width), "part int, entry int, n bigint, total array<bigint>")
    whole = [F.sum(F.col("total")[k].cast("decimal(38,0)")).alias(f"t{k}") for k in range(width)]
    after = books.copy()
    for row in sums.groupBy("part", "entry").agg(F.sum("n").alias("n"), *whole).collect():
        after[row["part"], row["entry"]] = [int(row[f"t{k}"]) // row["n"] for k in range(width)]
    return after, (after != books).any(axis=2)


def code_vectors(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS) -> DataFrame:
    """vec_id, code, error, label_error and codebooks_sha256 of every vector that can be coded.

    Components become floor(256 * x). Vectors are cut into ``parts`` equal consecutive parts, each
    with a codebook that starts as that part of the ``entries`` rows of least id. A round assigns
    every part to the nearest entry (the lower index of equals) and moves each used entry to the
    floor of its parts' mean; after ``rounds`` rounds all parts are assigned once more. The state of
    a vector (codes and exact distances) is written after every assignment; the next one compares
    parts whose entry did not move with moved entries only, all others with the whole codebook. What
    the driver holds is the codebooks, ``entries`` x dimensions numbers.

    Left out are vectors that are null, empty, hold a null or non-finite component or one beyond
    2**18 (its squared distance would leave 64 bits), and those of another length than the first
    coded row's; a length that ``parts`` does not divide counts as none. Rows without an id are
    coded, but start no entry. Repeated rows count as often as they are there, also as starting
    entries. Rows of null label share one label_error. With fewer rows than ``entries`` the
    codebooks are smaller; an empty table gives no rows. Other columns are not looked at.
    """
    spark = rows.sparkSession
    named = rows.select(F.col(key).cast("bigint").alias("row_id"), F.col(label).cast("string").alias("label_key"),
                        whole_numbers(F.col(vector)).alias("v"))
    named = named.where(F.col("v").isNotNull() & (F.size("v") > 0) & (F.size("v") % parts == 0))
    first = named.where(F.col("row_id").isNotNull()).orderBy("row_id", "v").select("v")
    start = [r["v"] for r in first.limit(entries).collect()]
    if not start:
        return spark.createDataFrame([], "vec_id bigint, code string, error bigint, label_error bigint, codebooks_sha256 string")
    size = len(start[0])
    if any(len(v) != size for v in start):
        start = [r["v"] for r in first.where(F.size("v") == size).limit(entries).collect()]
    books = np.ascontiguousarray(np.array(start, np.int64).reshape(len(start), parts, -1).transpose(1, 0, 2))
    named = named.where(F.size("v") == size).withColumns({"code": F.lit(None).cast("binary"), "error": F.lit(None).cast("array<bigint>")})
    state = kept(named.mapInArrow(_assign_task(books, None), STATE), "codes")
    for _ in range(rounds):
        books, moved = _moved_books(state, books)
        before = state
        state = kept(before.mapInArrow(_assign_task(books, moved), STATE), "codes")
        forget(before)
    total = F.aggregate("error", F.lit(0).cast("bigint"), lambda a, x: a + x)
    coded = state.select("row_id", "label_key", F.lower(F.hex("code")).alias("code"), total.alias("error"))
    sums = coded.groupBy(F.col("label_key").alias("_label")).agg(F.sum("error").alias("label_error"))
    numbers = ",".join(map(str, books.ravel().tolist()))
    return coded.join(sums, F.col("label_key").eqNullSafe(F.col("_label"))).select(
        F.col("row_id").alias("vec_id"), "code", "error", "label_error",
        F.lit(hashlib.sha256(numbers.encode()).hexdigest()).alias("codebooks_sha256"),
    )
