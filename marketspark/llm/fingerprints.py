"""Document fingerprints from closed syncmers; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import bind
from marketspark.operators.ordering import BLOCK, CUT, keyed_join, with_blocks
from marketspark.operators.skew import small_side

#: Fragments of words: runs of other signs than ASCII blanks, of four code points at most.
FRAGMENT = r"[^\x20\x09-\x0D]{1,4}"
#: Fragments of an anchor, and of the inner strings whose least one decides.
K = 5
S = 2
#: Anchors of a fingerprint: those of least hash.
KEPT = 64
#: Documents that are put in order together.
BLOCK_ROWS = 4096

ANCHOR = "array<struct<hash:bigint,start:int>>"


def anchors(text: Column, *, kept: int | None = KEPT, k: int = K, s: int = S) -> Column:
    """The closed syncmers of ``text`` as an array of (hash, start), by hash.

    A text is the sequence of its FRAGMENTs; ``start`` counts them from 0. A window of ``k`` fragments
    is an anchor if, of the hashes of its ``s``-fragment inner strings, the first or the last is a least
    one. That depends on the window alone, so a passage has the same anchors wherever it stands.
    Fewer than ``k`` fragments are one window and an anchor as they are. Each hash has its first
    start; with ``kept`` only the anchors of that many least hashes stay. Null or without fragments:
    an empty array.

    Every step's array is bound to a name, so that no step is made again for each of its elements.
    """
    if not 1 < s < k - 1:
        raise ValueError("inner strings need at least three places in a window")

    def run(values: Column, i: Column, n: int) -> Column:
        return F.xxhash64(*[F.get(values, i + j) for j in range(n)])

    def numbers(last: Column) -> Column:
        return F.sequence(F.lit(0), last)

    def windows(pieces: Column, inner: Column) -> Column:
        def is_anchor(i: Column) -> Column:
            edge = F.least(F.get(inner, i), F.get(inner, i + (k - s)))
            return edge <= F.least(*[F.get(inner, i + j) for j in range(1, k - s)])

        return bind(F.filter(numbers(F.size(pieces) - k), is_anchor),
                    lambda places: bind(F.transform(places, lambda i: run(pieces, i, k)), lambda hashes: least(hashes, places)))

    def anchor(hashes: Column, places: Column) -> Callable[..., Column]:
        return lambda x, j: F.struct(x.alias("hash"), F.get(places, j).alias("start"))

    def least(hashes: Column, places: Column) -> Column:
        def chosen(most: Column) -> Column:
            return F.array_compact(F.transform(hashes, lambda x, j: F.when(x <= most, anchor(hashes, places)(x, j))))

        if kept is None:
            some = F.transform(hashes, anchor(hashes, places))
        else:
            some = bind(F.array_max(F.slice(F.sort_array(F.array_distinct(hashes)), 1, kept)), chosen)
        return bind(F.sort_array(some), lambda some: F.filter(some, lambda x, j: (j == 0) | (x["hash"] != F.get(some, j - 1)["hash"])))

    def whole(pieces: Column) -> Column:
        one = F.aggregate(pieces, F.lit(42).cast("bigint"), lambda so_far, x: F.xxhash64(so_far, x))
        return F.array(F.struct(one.alias("hash"), F.lit(0).alias("start")))

    def found(pieces: Column) -> Column:
        inner = F.transform(numbers(F.size(pieces) - s), lambda i: run(pieces, i, s))
        many = bind(inner, lambda inner: windows(pieces, inner))
        return F.when(F.size(pieces) >= k, many).when(F.size(pieces) > 0, whole(pieces)).otherwise(F.array().cast(ANCHOR))

    fragments = F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(FRAGMENT), F.lit(0))
    return bind(F.transform(fragments, lambda x: F.xxhash64(x)), found).cast(ANCHOR)


def fingerprint(hashes: Column, starts: Column) -> Column:
    """Anchors as text: hash in hexadecimal, ``@`` and start, divided by blanks."""
    return F.array_join(F.zip_with(hashes, starts, lambda x, i: F.concat(F.lower(F.hex(x)), F.lit("@"), i.cast("string"))), " ")


def likeness(a: Column, b: Column, kept: int | None = KEPT) -> Column:
    """Share of the ``kept`` least hashes of both, of all if it is None, that both have; 1 if neither has any."""
    least, both = F.array_union(a, b), F.array_intersect(a, b)
    if kept is not None:
        least = F.slice(F.sort_array(least), 1, kept)
        both = F.array_intersect(both, least)
    return F.when(F.size(least) == 0, F.lit(1.0)).otherwise(F.size(both) / F.size(least))


def matches(a: Column, b: Column) -> Column:
    """Places of the anchors that both have: an array of (start in a, start in b), by the first."""
    def both(others: Column) -> Column:
        def found(x: Column) -> Column:
            own = F.get(F.filter(others, lambda y: y["hash"] == x["hash"]), F.lit(0))
            return F.when(own.isNotNull(), F.struct(x["start"].alias("start"), own["start"].alias("other")))

        return F.array_sort(F.array_compact(F.transform(a, found)))

    return bind(b, both)


def with_previous(rows: DataFrame, order: list[str], derive: Callable[[DataFrame], DataFrame], *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``derive(rows)`` with ``previous``: the row before in ``order``; the first row has the last one.

    Rows are put in order within blocks cut at sampled values of ``order``; only then is ``derive``
    called, so that what it adds is not shuffled. The last row of every block is looked up for the
    first of the next; these few are broadcast if their size allows it.
    """
    whole = Window.partitionBy(BLOCK).orderBy(*order)
    largest = rows.count()
    if largest > block_rows:
        blocked = with_blocks(rows, order=order, largest=largest, block_rows=block_rows).df.drop(CUT)
    else:
        blocked = rows.withColumn(BLOCK, F.lit(0).cast("bigint"))
    keys = blocked.groupBy(BLOCK).agg(F.max(F.struct(*order)).alias("_end"))
    every = Window.partitionBy(F.lit(0))  # one row a block, of which there is a bounded number
    before = F.coalesce(F.lag("_end").over(every.orderBy(BLOCK)), F.max_by("_end", BLOCK).over(every))
    keys = keys.select(F.col(BLOCK).alias("_of"), before.alias("_end"))
    ends = keyed_join(blocked.drop(BLOCK).withColumn("_end", F.struct(*order)), F.broadcast(keys), ["_end"], "inner")
    ends = derive(ends.dropDuplicates(["_of"]).drop("_end"))
    ends = small_side(ends.select("_of", F.struct(*[c for c in ends.columns if c != "_of"]).alias("_before")))
    marked = derive(blocked.repartition(BLOCK).sortWithinPartitions(BLOCK, *order))
    marked = marked.withColumn("previous", F.lag(F.struct(*[c for c in marked.columns if c != BLOCK])).over(whole))
    joined = marked.join(ends, F.col(BLOCK) == F.col("_of"), "left")
    return joined.withColumn("previous", F.coalesce("previous", "_before")).drop(BLOCK, "_of", "_before")


def compare_edited(docs: DataFrame, *, key: str = "doc_id", text: str = "text", kept: int | None = KEPT, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """Fingerprints of every text and of its edited text, and how alike they are.

    A fingerprint has the anchors of the ``kept`` least hashes, and likeness is then an estimate; with
    ``kept=None`` it has all anchors of the text, and likeness is the share of all hashes of both.

    Returns doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited and near_next.
    The edited text is the text with its last third (rounded down, in code points) replaced by as
    much of the beginning of the next document's, or all of it; next is by falling id, and the last
    one's is the first. ``near_next`` compares with the next document as it is.

    A null text is empty. Texts without a word have an empty fingerprint, alike to each other (1) and to
    nothing else (0). Texts of any length are taken whole. Null ids come last; rows of one id go by a
    hash of their text, and rows that repeat follow one another in any order, being the same. A
    single row is its own next. An empty table gives no rows. Other columns are not looked at.
    """
    def marked(rows: DataFrame) -> DataFrame:
        rows = rows.withColumn("anchors", anchors(F.col("text"), kept=kept))
        return rows.withColumns({"hashes": F.col("anchors")["hash"], "starts": F.col("anchors")["start"]}).drop("anchors")

    rows = docs.select(F.col(key).alias("doc_id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    placed = with_previous(rows.withColumn("tie", F.xxhash64("text")), ["doc_id", "tie"], marked, block_rows=block_rows)
    length, following = F.char_length("text"), F.col("previous")
    cut = F.floor(length / 3).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), length - cut), F.substring(following["text"], F.lit(1), cut))
    placed = placed.select("doc_id", length.cast("bigint").alias("n_chars"), edited.alias("edited"), "hashes", "starts",
                           following["hashes"].alias("next_hashes"))
    placed = placed.withColumns({"edited_sha256": F.sha2("edited", 256), "anchors": anchors(F.col("edited"), kept=kept)})
    changed = F.col("anchors")["hash"]
    return placed.select(
        "doc_id", "n_chars", "edited_sha256", fingerprint(F.col("hashes"), F.col("starts")).alias("fingerprint"),
        fingerprint(changed, F.col("anchors")["start"]).alias("edited_fingerprint"),
        likeness(F.col("hashes"), changed, kept).alias("near_edited"),
        likeness(F.col("hashes"), F.col("next_hashes"), kept).alias("near_next"),
    )
