"""Repeatable splits, samples and class balancing, by the hash order of a unique row key.

The order of rows is the order of ``md5(key-seed)``, the same for any partitioning.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.operators.ordering import with_positions
from marketspark.operators.skew import bounded, salted_join, written

PREFIX = 4
FEW = 50_000
DRAW_ROWS = 1_000_000
MAX_DRAW_TASKS = 20_000


def row_token(key: Sequence[str], seed: int) -> Column:
    """Hash of the key and seed that gives a row its place.

    Each part has its length in front and a null reads ``-``, so different keys stay different.
    """
    def part(c: str) -> Column:
        text = F.col(c).cast("string")
        return F.when(text.isNull(), F.lit("-")).otherwise(F.concat(F.length(text).cast("string"), F.lit(":"), text))

    return F.md5(F.concat_ws("|", *[part(c) for c in key], F.lit(str(seed))))


def _number(token: Column, digits: int) -> Column:
    return F.conv(F.substring(token, 1, digits), 16, 10).cast("bigint")


def _kth_token(tokens: DataFrame, place: Callable[[int], int]) -> str | None:
    """The k-th smallest token, k = place(rows), found by counting prefixes of growing length.

    Rows that share the limiting token cannot be told apart: that is an error at any size.
    """
    prefix, wanted = "", None
    while True:
        size = len(prefix) + PREFIX
        inside = tokens.where(F.col("token").startswith(prefix)) if prefix else tokens
        counts = inside.groupBy(F.substring("token", 1, size).alias("p")).count().collect()
        counts.sort()
        if wanted is None:
            wanted = place(sum(c["count"] for c in counts))
            if wanted == 0:
                return None
        for row in counts:
            if wanted <= row["count"]:
                break
            wanted -= row["count"]
        prefix = row["p"]
        if row["count"] <= FEW:
            few = sorted(r["token"] for r in tokens.where(F.col("token").startswith(prefix)).collect())
            if few[wanted:wanted + 1] == few[wanted - 1:wanted]:
                raise ValueError("the key is not unique")
            return few[wanted - 1]
        if size >= 32:
            if wanted < row["count"]:
                raise ValueError("the key is not unique")
            return prefix


def _first_tokens(df: DataFrame, token: Column, place: Callable[[int], int]) -> Column:
    """Is a row among the first place(rows) in hash order?"""
    limit = _kth_token(df.select(token.alias("token")), place)
    return F.lit(False) if limit is None else token <= limit


def split_exact(
    df: DataFrame, *, key: Sequence[str], test_size: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Mark ceil(test_size * n) rows ``test``, the others ``train``.

    The limiting hash is found from counts of hash prefixes over the key column alone; marking
    the rows is then a filter-like projection, with no shuffle of the rows.
    """
    test = _first_tokens(df, row_token(key, seed), lambda rows: math.ceil(test_size * rows))
    return df.withColumn(name, F.when(test, "test").otherwise("train"))


def split_hash(
    df: DataFrame, *, key: Sequence[str], test_size: float = 0.2, seed: int = 42, name: str = "split"
) -> DataFrame:
    """Mark about ``test_size`` of the rows ``test``, each row for itself."""
    limit = int(test_size * 16**7)
    is_test = _number(row_token(key, seed), 7) < limit
    return df.withColumn(name, F.when(is_test, "test").otherwise("train"))


def take_sample(df: DataFrame, n: int, *, key: Sequence[str], seed: int = 42) -> DataFrame:
    """The first ``n`` rows in hash order, cut off by their limiting hash: a filter, not a sort."""
    return df.where(_first_tokens(df, row_token(key, seed), lambda rows: min(n, rows)))


def head(df: DataFrame, *, order: Sequence[str], n: int = 1) -> DataFrame:
    """The first rows of the source order."""
    return df.orderBy(*order).limit(n)


def oversample(
    df: DataFrame, *, label: str, key: Sequence[str], seed: int = 42,
    columns: Sequence[str] | None = None, draw_rows: int = DRAW_ROWS,
) -> DataFrame:
    """All rows, plus random repeats until every class has as many rows as the largest.

    A class of n rows that lacks m gets m draws; draw k takes the row at place
    ``hash(class, k, seed) mod n`` of the class in hash order. Draws are made in chunks spread
    over tasks, and when a small class is drawn very often its rows are repeated over salts.
    """
    columns = list(columns or df.columns)
    sizes = written(df.where(F.col(label).isNotNull()).groupBy(label).agg(F.count(F.lit(1)).alias("_n")))
    top = sizes.agg(F.max("_n")).first()[0] or 0
    short = sizes.where(F.col("_n") < top).select(
        F.col(label), "_n", (F.lit(top) - F.col("_n")).alias("_need"),
    ).withColumn("_salts", F.ceil(F.col("_need") / F.col("_n") / draw_rows))
    chunk_count = F.ceil(F.col("_need") / draw_rows)
    largest, chunks = short.agg(F.max("_n"), F.sum(chunk_count)).first()
    if largest is None:
        return df.select(*columns)

    # a given number of partitions, which Spark does not merge for being small before the explode
    chunked = short.withColumn(
        "_chunk", F.explode(F.sequence(F.lit(0), chunk_count - 1))
    ).repartition(min(chunks, MAX_DRAW_TASKS), label, "_chunk")
    last = F.least(F.col("_need"), (F.col("_chunk") + 1) * draw_rows)
    draws = chunked.withColumn("_draw", F.explode(F.sequence(F.col("_chunk") * draw_rows + 1, last)))
    pick = F.md5(F.concat_ws("-", F.col(label).cast("string"), F.col("_draw").cast("string"), F.lit(str(seed))))
    draws = draws.select(
        F.col(label).alias("_label"),
        F.pmod(_number(pick, 15), F.col("_n")).alias("_place"),
        F.pmod(F.col("_draw"), F.col("_salts")).alias("_salt"),
    )
    classes, small = bounded(short.select(label, "_salts"))
    minority = df.join(classes, label) if small else salted_join(df, classes, [label], row_key=key)
    minority = minority.withColumn("_token", _number(row_token(key, seed), 15))
    placed = with_positions(
        minority, by=[label], order=["_token", *key], name="_place", largest=largest
    )
    placed = placed.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.col("_salts") - 1)))
    repeats = placed.join(
        draws,
        (placed[label] == draws["_label"]) & (placed["_place"] == draws["_place"])
        & (placed["_salt"] == draws["_salt"]),
    ).select(*[placed[c] for c in columns])
    return df.select(*columns).unionByName(repeats)
