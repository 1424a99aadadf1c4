"""Near copies among vectors: int8 tile products with an error bound, then full precision."""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import kept
from marketspark.llm.graph import components

THRESHOLD = 0.98
#: Vectors of one side of a tile.
TILE = 2048
#: Rows of a tile that are multiplied, and pairs that are computed again, at a time.
ROWS = 256
PAIRS = 1 << 15
#: Products of int8 values stay whole numbers below 2**24 in float32 for so many dimensions.
EXACT_DIMENSIONS = 1024
SLACK = 1e-9


def usable(vector: Column) -> Column:
    """Neither null nor zero nor with a null or non-finite component."""
    def finite(x):
        return F.coalesce(~F.isnan(x) & (F.abs(x) < float("inf")), F.lit(False))

    return F.coalesce(F.forall(vector, finite) & F.exists(vector, lambda x: F.coalesce(x != 0, F.lit(False))), F.lit(False))


def quantised(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Int8 values, scale and length of the error of every unit vector (a row of ``x``).

    With u = s q + e, the product of two unit vectors differs from s s' q.q' by at most
    (1 + |e|) |e'| + |e|.
    """
    scale = np.abs(x).max(axis=1, initial=1e-300) / 127.0
    q = np.rint(x / scale[:, None]).astype(np.int8)
    return q, scale, np.linalg.norm(x - q * scale[:, None], axis=1)


def _products(q: np.ndarray, r: np.ndarray) -> np.ndarray:
    total = None
    for at in range(0, max(1, q.shape[1]), EXACT_DIMENSIONS):
        part = q[:, at:at + EXACT_DIMENSIONS].astype(np.float32) @ r[:, at:at + EXACT_DIMENSIONS].astype(np.float32).T
        total = part if total is None else total.astype(np.float64) + part
    return total


def tile_links(left: np.ndarray, right: np.ndarray, threshold: float, one: bool) -> tuple[np.ndarray, np.ndarray]:
    """Index pairs (left, right) with a cosine of ``threshold`` or more in double precision.

    ``one``: both sides are one tile and each pair counts once.
    """
    lengths, others = np.linalg.norm(left, axis=1), np.linalg.norm(right, axis=1)
    q, s, e = quantised(left / lengths[:, None])
    r, t, f = quantised(right / others[:, None])
    found_i, found_j = [], []
    for at in range(0, len(left), ROWS):
        rows = slice(at, at + ROWS)
        most = _products(q[rows], r) * (s[rows, None] * t) + ((1.0 + e[rows, None]) * f + e[rows, None] + SLACK)
        i, j = np.nonzero(most >= threshold)
        i += at
        if one:
            i, j = i[i < j], j[i < j]
        for k in range(0, len(i), PAIRS):
            a, b = i[k:k + PAIRS], j[k:k + PAIRS]
            cosine = np.einsum("ij,ij->i", left[a], right[b]) / (lengths[a] * others[b])
            found_i.append(a[cosine >= threshold])
            found_j.append(b[cosine >= threshold])
    none = np.empty(0, np.int64)
    return np.concatenate([none, *found_i]), np.concatenate([none, *found_j])


def roots(n: int, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """The least index that links (i, j) reach from each of ``n`` indices."""
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, i, low)
        np.minimum.at(root, j, low)
        np.minimum.at(root, before, root)
        root = root[root]
        if (root == before).all():
            break
    return root


def _tile_task(threshold: float):
    def task(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        low, high = key[-2:]
        rows = rows.sort_values("vec_id", kind="stable")
        vectors = np.stack([np.asarray(v, np.float64) for v in rows["vector"]])
        ids, copies, side = rows["vec_id"].to_numpy(), rows["copies"].to_numpy(), rows["tile"].to_numpy()
        a, b = np.flatnonzero(side == low), np.flatnonzero(side == high)
        i, j = tile_links(vectors[a], vectors[b], threshold, low == high)
        i, j = a[i], b[j]
        links = np.zeros(len(rows), np.int64)
        np.add.at(links, i, copies[j])
        np.add.at(links, j, copies[i])
        root = roots(len(rows), i, j)
        some = links > 0
        return pd.DataFrame({"vec_id": ids[some], "links": links[some], "root": ids[root[some]]})

    return task


def near_vectors(rows: DataFrame, *, key: str = "vec_id", vector: str = "embedding", label: str = "label",
                 threshold: float = THRESHOLD, tile: int = TILE) -> DataFrame:
    """vec_id, n_links, component_id and kept of every row.

    Vectors of one label and length are compared, all with all: a label's vectors are spread over
    tiles of about ``tile`` by the hash of their id, and every pair of tiles is a task of its own,
    so a hot label is many tasks of one size. A task multiplies int8 values, bounds every
    product's error from the two quantisation errors, and computes in double precision the pairs
    that could reach the threshold. It returns counts and a spanning forest, not the pairs.
    Equal vectors are one vector with a number of copies.

    Vectors that are null, empty, zero, or hold null or non-finite components, and those without
    a label, link with nothing and are kept. A null id is no node: its row links with nothing.
    Repeated rows are vectors of their own for the counts; rows of one id and different vectors
    share a component and their counts. An empty table gives no rows. Other columns are not
    looked at.
    """
    named = rows.select(F.col(key).cast("bigint").alias("vec_id"), F.col(vector).alias("vector"), F.col(label).alias("label"))
    named = named.withColumn("ok", usable(F.col("vector")) & F.col("label").isNotNull() & F.col("vec_id").isNotNull())
    named = named.withColumn("vector", F.when(F.col("ok"), F.col("vector")))
    good = named.where("ok")
    classes = good.groupBy("label", "vector").agg(F.min("vec_id").alias("rep"), F.count(F.lit(1)).alias("copies"))
    classes = kept(classes.withColumn("dim", F.size("vector")), "vector-classes")
    tiles = classes.groupBy("label", "dim").agg(F.ceil(F.count(F.lit(1)) / tile).cast("int").alias("tiles"))
    spread = classes.join(tiles, ["label", "dim"]).withColumn("tile", F.pmod(F.xxhash64("rep"), F.col("tiles")).cast("int"))
    paired = spread.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("tiles") - 1))).select(
        "label", "dim", F.least("tile", "other").alias("low"), F.greatest("tile", "other").alias("high"),
        F.col("rep").alias("vec_id"), "copies", "tile", "vector",
    )
    found = paired.groupBy("label", "dim", "low", "high").applyInPandas(_tile_task(threshold), "vec_id bigint, links bigint, root bigint")
    found = kept(found, "vector-links")
    counts = found.groupBy(F.col("vec_id").alias("rep")).agg(F.sum("links").alias("links"))
    reached = components(found.select(F.col("vec_id").alias("a"), F.col("root").alias("b")))
    reps = classes.select("label", "vector", "rep", "copies").join(counts, "rep", "left")
    reps = reps.join(reached.withColumnRenamed("node", "rep"), "rep", "left").withColumnRenamed("label", "_label").withColumnRenamed("vector", "_vector")
    joined = named.join(reps, (F.col("label") == F.col("_label")) & (F.col("vector") == F.col("_vector")), "left")
    return joined.select(
        "vec_id", F.coalesce(F.col("copies") - 1 + F.coalesce("links", F.lit(0)), F.lit(0)).cast("bigint").alias("n_links"),
        F.coalesce("component", "rep", "vec_id").alias("component_id"),
    ).withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(True)))
