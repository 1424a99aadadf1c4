"""Connected components of a table of links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import forget, kept


def _stars(links: DataFrame) -> DataFrame:
    """Every node's larger neighbours to its least one, then every node's smaller ones to theirs."""
    both = links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    large = both.where("b > a").join(least, "a").select(F.col("b").alias("a"), F.col("m").alias("b"))
    large = large.where("a <> b").distinct()
    least = large.groupBy("a").agg(F.min("b").alias("m"))
    smaller = large.join(least, "a")
    small = smaller.where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return small.unionByName(least.select("a", F.col("m").alias("b"))).distinct()


def components(links: DataFrame) -> DataFrame:
    """node, component for every node of ``links`` (a, b): the least node that links reach.

    Alternates the two star steps until nothing changes, about as many times as the logarithm of the
    longest chain. No neighbourhood is gathered: a step is a combined minimum and a join back.
    Every step is written, so a lost executor costs one step. Null ends and loops are left out;
    no links give no rows.
    """
    clean = links.where("a is not null and b is not null and a <> b")
    now = kept(clean.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "links")
    state = None
    while True:
        found = now.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b")), F.sum(F.hash("a", "b").cast("bigint"))).first()
        if tuple(found) == state or found[0] == 0:
            break
        state = tuple(found)
        before, now = now, kept(_stars(now), "links")
        forget(before)
    named = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return named.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
