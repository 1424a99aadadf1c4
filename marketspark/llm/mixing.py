"""Mix sources to target weights: whole epochs first, then a weighted draw up to the budget."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import draw, kept, n_words

WEIGHTS = (3, 1, 2)
#: Share of all words that the mix takes, as a fraction of integers, and most epochs of a source.
SHARE = (3, 2)
MOST = 2
BUCKETS = 1024


def quality(text: Column) -> Column:
    """A weight from 0.5 to 1.5 by the share of ASCII letters; 0.5 for null or empty texts."""
    letters = F.length(F.regexp_replace(text, "[^A-Za-z]+", ""))
    return F.lit(0.5) + F.coalesce(letters / F.nullif(F.length(text), F.lit(0)), F.lit(0.0))


def keyed(docs: DataFrame, *, key: str, text: str, source: str, weight: Column | None = None, seed: int = 17,
          carry: Column | None = None) -> DataFrame:
    """Key, source, size in words, exponential sort key and its two buckets; ``carry`` goes along.

    The sort key is ``-ln(u) / weight`` (Efraimidis-Spirakis): ordered by it, a prefix is a draw
    without replacement in proportion to the weights.
    """
    weight = quality(F.col(text)) if weight is None else weight
    carried = [] if carry is None else ["row"]
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(source).alias("source"), n_words(F.col(text)).alias("size"),
        (-F.log(draw(F.col(key), seed)) / weight).alias("sort_key"), *[carry.alias(c) for c in carried],
    )
    even = (F.lit(1.0) - F.exp(-F.col("sort_key"))) * BUCKETS
    rows = rows.withColumn("_even", F.least(even, F.lit(BUCKETS - 0.5)))
    first = F.floor("_even")
    second = F.least(F.floor((F.col("_even") - first) * BUCKETS), F.lit(BUCKETS - 1))
    return rows.select("doc_id", "source", "size", "sort_key", first.alias("b1"), second.alias("b2"), *carried)


def targets(rows: DataFrame, *, weights: Sequence[int] = WEIGHTS, share: tuple[int, int] = SHARE, most: int = MOST) -> DataFrame:
    """One row a source: its size, the words it should give, whole epochs and what is left of them.

    Sources weigh ``weights`` in turn, by code point with null last. Whoever reaches ``most``
    times its size stops there and the rest is shared by weight again: with the sources sorted by
    cap over weight, the level is what the sorted prefix leaves, over the weights behind it.
    """
    sizes = rows.groupBy("source").agg(F.sum("size").alias("source_size"))
    turn = F.pmod(F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1, F.lit(len(weights)))
    weighed = sizes.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (turn + 1).cast("int")))
    cap = F.col("source_size") * most
    by_ratio = Window.orderBy(cap / F.col("weight"), F.asc_nulls_last("source"))
    before, whole = by_ratio.rowsBetween(Window.unboundedPreceding, -1), Window.partitionBy()
    all_words = F.sum("source_size").over(whole)
    level = (all_words * share[0] / F.lit(float(share[1])) - F.coalesce(F.sum(cap).over(before), F.lit(0))) / (
        F.sum("weight").over(whole) - F.coalesce(F.sum("weight").over(before), F.lit(0))
    )
    levels = weighed.withColumn("_level", level).withColumn("_full", F.col("_level") * F.col("weight") >= cap)
    rest = F.min(F.when(~F.col("_full"), F.struct(F.col("source_size") * most / F.col("weight"), "_level"))).over(whole)["_level"]
    target = F.when(F.col("_full"), cap.cast("double")).otherwise(rest * F.col("weight"))
    epochs = F.coalesce(F.floor(F.col("target") / F.nullif(F.col("source_size"), F.lit(0))), F.lit(0))
    return levels.withColumn("target", target).withColumn("epochs", epochs).select(
        "source", "source_size", "target", "epochs",
        (F.col("target") - F.col("epochs") * F.col("source_size")).alias("left"),
    )


def _boundary(sums: DataFrame, by: list[str], bucket: str) -> DataFrame:
    """For each group the bucket in which the running sum passes what is left, and what it leaves."""
    upto = Window.partitionBy(*by).orderBy(bucket)
    summed = sums.withColumn("_upto", F.sum("_size").over(upto))
    crossing = summed.where((F.col("_upto") > F.col("left")) & (F.col("_upto") - F.col("_size") <= F.col("left")))
    return crossing.select(*by, bucket, (F.col("left") - (F.col("_upto") - F.col("_size"))).alias("left"))


def cuts(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """The plan with the place of each source's last drawn document in the order of sort keys.

    Running sums go over buckets of the key (1,024 a source), then over the 1,024 parts of the one
    bucket where the budget ends, then over the rows of that part: no task sorts a source.
    """
    def matched(left, right, on):
        renamed = right.select(*[F.col(c).alias(f"_{c}") for c in right.columns])
        condition = F.lit(True)
        for c in on:
            condition = condition & F.col(c).eqNullSafe(F.col(f"_{c}"))
        extra = [F.col(f"_{c}").alias(c) for c in right.columns if c not in on]
        return left.join(renamed, condition).select(*left.columns, *extra)

    sums = rows.groupBy("source", "b1").agg(F.sum("size").alias("_size"))
    first = _boundary(matched(sums, plan.select("source", "left"), ["source"]), ["source"], "b1")
    sums = matched(rows, first.select("source", "b1"), ["source", "b1"]).groupBy("source", "b1", "b2").agg(F.sum("size").alias("_size"))
    second = _boundary(matched(sums, first, ["source", "b1"]), ["source", "b1"], "b2")
    near = matched(rows, second, ["source", "b1", "b2"])
    place = Window.partitionBy("source", "b1", "b2").orderBy("sort_key", F.col("doc_id").cast("string"), "size")
    middle = 2 * F.sum("size").over(place.rowsBetween(Window.unboundedPreceding, 0)) - F.col("size")
    last = F.struct("sort_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "size")
    drawn = near.withColumn("_drawn", middle <= 2 * F.col("left"))
    ends = drawn.groupBy("source", "b1", "b2").agg(F.max(F.when(F.col("_drawn"), last)).alias("last"))
    return plan.join(ends.withColumnRenamed("source", "_source"), F.col("source").eqNullSafe(F.col("_source")), "left").drop("_source")


def planned(rows: DataFrame, **shares) -> DataFrame:
    """The written plan for ``rows`` as ``keyed`` gives them: one row a source."""
    return kept(cuts(rows, kept(targets(rows, **shares), "mix-targets")), "mix-plan")


def decided(rows: DataFrame, plan: DataFrame) -> DataFrame:
    """``rows`` with source_size, target and copies: looked up in the plan, row by row."""
    plan = plan.select(F.col("source").alias("_source"), "source_size", "target", "epochs",
                       F.col("b1").alias("_b1"), F.col("b2").alias("_b2"), "last")
    placed = F.struct("sort_key", F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"), "size")
    drawn = F.struct("b1", "b2") < F.struct("_b1", "_b2")
    drawn = drawn | ((F.col("b1") == F.col("_b1")) & (F.col("b2") == F.col("_b2")) & (placed <= F.col("last")))
    copies = F.col("epochs") + F.when(F.col("_b1").isNotNull() & drawn, 1).otherwise(0)
    joined = rows.join(plan, F.col("source").eqNullSafe(F.col("_source")))
    return joined.select(*rows.columns, "source_size", "target", copies.cast("bigint").alias("copies"))


def mix(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
        seed: int = 17, **shares) -> DataFrame:
    """One row a document: doc_id, source, size, source_size, target, copies, taken.

    ``copies`` counts a document's uses: the whole epochs of its source, and one more if the draw
    takes it. The draw goes along the sort keys and stops with the document whose inclusion brings
    the sum nearest to what the epochs leave, so a source is off by half a document at most.

    Null or empty texts have size 0 and take nothing. A null source is a source of its own, the
    last one. Rows with equal keys have equal draws and are decided alike. An empty table gives no rows. Other
    columns are not looked at. Nothing is larger than one row a source and bucket but the rows.
    """
    rows = kept(keyed(docs, key=key, text=text, source=source, weight=weight, seed=seed), "mix-rows")
    found = decided(rows, planned(rows, **shares))
    return found.select("doc_id", "source", "size", "source_size", "target", "copies", (F.col("copies") * F.col("size")).alias("taken"))


def mixed_documents(docs: DataFrame, *, key: str = "doc_id", text: str = "text", source: str = "source", weight: Column | None = None,
                    seed: int = 17, **shares) -> DataFrame:
    """The documents of the mix, as often as it uses them, with the columns of ``docs``.

    Each row is decided where it is: the texts are not shuffled.
    """
    settings = {"key": key, "text": text, "source": source, "weight": weight, "seed": seed}
    plan = planned(kept(keyed(docs, **settings), "mix-rows"), **shares)
    found = decided(keyed(docs, **settings, carry=F.struct("*")), plan).where("copies > 0")
    return found.select("row", F.explode(F.sequence(F.lit(1), F.col("copies").cast("int")))).select("row.*")
