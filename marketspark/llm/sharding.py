"""Shards that each hold the mixture: rows interleaved in proportion to their source."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import draw, kept, ranked

SHARDS = 8


def interleave(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source",
               shards: int = SHARDS, seed: int = 29, buckets: int = 1024) -> DataFrame:
    """doc_id, source, size, text_crc32, place, shard and slot of every row.

    Rows of a source are shuffled by a seeded draw and ranked; rank plus draw over the source's size is
    the row's place between 0 and 1, so that many small sources spread evenly too. All rows in the order
    of their places are cut into shards whose row counts differ by one at most, so each shard holds
    each source in its share, give or take a row or two a source. Both ranks are counted over buckets of
    numbers that are spread evenly, so no task holds a source.

    Null texts count as empty (size 1, crc32 0), a null source is one source, repeated rows are
    ranked one after the other, and an empty table gives no rows. Other columns are not looked at.
    """
    body = F.coalesce(F.col(text), F.lit("")).cast("binary")
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), (F.octet_length(body) + 1).cast("bigint").alias("size"),
        F.crc32(body).alias("text_crc32"), draw(F.col(key), seed).alias("_draw"),
    )
    ties = ["doc_id", "size", "text_crc32"]
    placed = ranked(kept(rows, "shard-rows"), ["source"], "_draw", ties, rank="_rank", total="_of", buckets=buckets)
    placed = kept(placed.withColumn("place", (F.col("_rank") + F.col("_draw")) / F.col("_of")), "shard-places")
    lined = ranked(placed, [], "place", ["source", *ties], rank="_row", total="_rows", buckets=buckets)
    shard = F.floor(F.col("_row") * shards / F.col("_rows"))
    return lined.withColumn("shard", shard.cast("int")).select(
        "doc_id", "source", "size", "text_crc32", "place", "shard",
        (F.col("_row") - F.ceil(F.col("shard") * F.col("_rows") / F.lit(shards))).cast("bigint").alias("slot"),
    )
