"""Ordered work over groups that may be too big for one task.

A Spark window sends each group to one task. That is right while groups are small, so every
operator here first asks for the size of the biggest group (one narrow count; pass ``largest``
when you know it). Only when a group is over the limit is it cut: into *blocks* at sampled
values of the order columns, for running totals, positions and fills, or into *pieces* of a
fixed number of rows with a margin of neighbours, for moving windows. The cut points decide
only where a group is divided; every row is kept and the results do not depend on them.

``order`` is a list of columns of any types that can be sorted, ascending with nulls first, together
unique within a group. Cuts are whole tuples of the group's and the order columns, sampled once, sorted,
and given to every task as one constant of bounded size; a row finds its block by one search among them.
Ties in some of the columns, nulls and texts with long shared beginnings are divided like anything else.
"""

from __future__ import annotations

import functools
import math
import operator
from collections.abc import Callable, Sequence
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from marketspark.session import shared_folder

BLOCK_ROWS = 500_000
MAX_BLOCKS = 32_768
SAMPLES_PER_BLOCK = 64
CUT_BYTES = 4 << 20
BROADCAST_BLOCKS = 1_000_000
BROADCAST_TEXTS = 10_000

BLOCK = "_block"
CUT = "_cut"
POSITION = "_pos"
PIECE = "_piece"
PLACE = "_place"


class Blocked(NamedTuple):
    """Rows with ``_block`` and ``_cut`` (is the group divided?), and a bound on the cut blocks."""

    df: DataFrame
    blocks: int


def largest_group(df: DataFrame, by: Sequence[str] = ()) -> int:
    """Rows in the biggest group; only one number reaches the driver."""
    if not by:
        return df.count()
    sizes = df.groupBy(*by).agg(F.count(F.lit(1)).alias("n"))
    return sizes.agg(F.max("n")).first()[0] or 0


def keyed_join(left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "left") -> DataFrame:
    """Null-safe equi-join that keeps the key columns of ``left``."""
    renamed = right.withColumnsRenamed({c: f"_r_{c}" for c in on})
    condition = functools.reduce(
        operator.and_, [F.col(c).eqNullSafe(F.col(f"_r_{c}")) for c in on]
    )
    return left.join(renamed, condition, how).drop(*[f"_r_{c}" for c in on])


def _place(by: Sequence[str], order: Sequence[str]) -> Column:
    """Where a row stands among all rows of all groups."""
    named = [F.col(c).alias(f"b{i}") for i, c in enumerate(by)] + [F.col(c).alias(f"t{i}") for i, c in enumerate(order)]
    return F.struct(*named)


def _cut_points(df: DataFrame, order: Sequence[str], by: Sequence[str], largest: int, block_rows: int) -> tuple[list[str], T.DataType]:
    """Places (as JSON) at which the groups that look bigger than a block are cut, and their type.

    About every ``block_rows``-th row of such a group, found among a hash sample of its rows. If all
    places together were longer than CUT_BYTES, only every second, fourth, ... one is taken, so
    that blocks grow and not what the driver and the tasks hold.
    """
    parts = min(math.ceil(largest / block_rows) + 1, MAX_BLOCKS)
    every = max(1, largest // (parts * SAMPLES_PER_BLOCK))
    step = max(math.ceil(block_rows / every), math.ceil(largest / every / MAX_BLOCKS))
    sample = df.select(_place(by, order).alias(PLACE))
    kind = sample.schema[PLACE].dataType
    if every > 1:
        sample = sample.where(F.pmod(F.xxhash64(PLACE), F.lit(every)) == 0)
    group = Window.partitionBy(*[F.col(PLACE)[f"b{i}"] for i in range(len(by))])
    numbered = sample.select(PLACE, F.row_number().over(group.orderBy(PLACE)).alias("n"), F.count(F.lit(1)).over(group).alias("size"))
    cuts = numbered.where((F.col("size") * every > block_rows) & (F.col("n") % step == 0))
    shared_folder(df.sparkSession)
    cuts = cuts.select(F.to_json(PLACE).alias("cut"), F.floor(F.col("n") / step).alias("number")).checkpoint()
    length = cuts.agg(F.sum(F.octet_length("cut") + 1)).first()[0] or 0
    thin = 1 << max(0, math.ceil(math.log2(max(1, length) / CUT_BYTES)))
    return [r["cut"] for r in cuts.where(F.col("number") % thin == 0).select("cut").collect()], kind


def _passed(cuts: Column, n: int, place: Column) -> Column:
    """How many of the ``n`` ascending cuts are at or before ``place``, by halving steps."""
    steps = [1 << i for i in reversed(range(n.bit_length()))]
    return F.aggregate(
        F.lit(steps),
        F.lit(0),
        lambda found, step: F.when(F.get(cuts, found + step - 1) <= place, found + step).otherwise(found),
    )


def with_blocks(
    df: DataFrame, *, order: Sequence[str], by: Sequence[str] = (), largest: int,
    block_rows: int = BLOCK_ROWS,
) -> Blocked:
    """Add ``_block``: contiguous runs of each group in ``order``, of about ``block_rows`` rows.

    ``_block`` is the number of cuts at or before the row, over all groups. What the cuts are
    decides only where a group is divided, so their way through JSON need not be exact.
    """
    found, kind = _cut_points(df, order, by, largest, block_rows)
    if not found:
        return Blocked(df.withColumns({BLOCK: F.lit(0).cast("bigint"), CUT: F.lit(False)}), 0)
    # folded by the optimizer into one literal
    cuts = F.sort_array(F.from_json(F.lit(f"[{','.join(found)}]"), T.ArrayType(kind)))
    placed = df.withColumn(PLACE, _place(by, order))
    placed = placed.withColumn(BLOCK, _passed(cuts, len(found), F.col(PLACE)).cast("bigint"))

    def own(cut: Column) -> Column:
        same = [cut[f"b{i}"].eqNullSafe(F.col(c)) for i, c in enumerate(by)]
        return functools.reduce(operator.and_, same, cut.isNotNull())

    near = F.exists(F.array(F.get(cuts, F.col(BLOCK) - 1), F.get(cuts, F.col(BLOCK))), own)
    return Blocked(placed.withColumn(CUT, near if by else F.lit(True)).drop(PLACE), 2 * len(found))


def _bring(local: DataFrame, carried: DataFrame, by: Sequence[str], blocks: int) -> DataFrame:
    """Join what earlier blocks left to the rows of each later block; few rows, bound known.

    Values of unknown length, such as texts, are broadcast for far fewer blocks than numbers.
    """
    sized = all(isinstance(f.dataType, (T.NumericType, T.DatetimeType, T.BooleanType)) for f in carried.schema if f.name not in {*by, BLOCK})
    if blocks <= (BROADCAST_BLOCKS if sized else BROADCAST_TEXTS):
        carried = F.broadcast(carried)
    return keyed_join(local, carried, [*by, BLOCK])


def running_total(
    df: DataFrame, totals: dict[str, Column | str], *, order: Sequence[str], by: Sequence[str] = (),
    largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add running sums in ``order``: a sum inside each block plus the sums of earlier blocks."""
    largest = largest_group(df, by) if largest is None else largest
    whole = Window.partitionBy(*by).orderBy(*order)
    upto = (Window.unboundedPreceding, Window.currentRow)
    if largest <= block_rows:
        return df.withColumns({k: F.sum(v).over(whole.rowsBetween(*upto)) for k, v in totals.items()})
    blocked, blocks = with_blocks(df, order=order, by=by, largest=largest, block_rows=block_rows)
    inside = Window.partitionBy(*by, BLOCK).orderBy(*order).rowsBetween(*upto)
    earlier = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)
    sums = blocked.where(CUT).groupBy(*by, BLOCK).agg(*[F.sum(v).alias(k) for k, v in totals.items()])
    starts = sums.select(
        *by, BLOCK, *[F.sum(k).over(earlier).alias(f"_start_{k}") for k in totals]
    )
    local = blocked.withColumns({k: F.sum(v).over(inside) for k, v in totals.items()})
    return _bring(local, starts, by, blocks).withColumns(
        {k: F.col(k) + F.coalesce(F.col(f"_start_{k}"), F.lit(0)) for k in totals}
    ).drop(BLOCK, CUT, *[f"_start_{k}" for k in totals])


def with_positions(
    df: DataFrame, *, order: Sequence[str], by: Sequence[str] = (), name: str = POSITION,
    largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Add the 0-based rank of each row in its group."""
    one = F.lit(1).cast("bigint")
    ranked = running_total(
        df, {name: one}, order=order, by=by, largest=largest, block_rows=block_rows
    )
    return ranked.withColumn(name, F.col(name) - 1)


def last_known(
    df: DataFrame, columns: Sequence[str], *, order: Sequence[str], by: Sequence[str] = (),
    largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Replace nulls with the latest earlier value; a block starts from the one before it."""
    if not columns:
        return df
    largest = largest_group(df, by) if largest is None else largest
    whole = Window.partitionBy(*by).orderBy(*order)
    if largest <= block_rows:
        w = whole.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        return df.withColumns({c: F.last(c, ignorenulls=True).over(w) for c in columns})
    blocked, blocks = with_blocks(df, order=order, by=by, largest=largest, block_rows=block_rows)
    inside = (
        Window.partitionBy(*by, BLOCK).orderBy(*order)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    earlier = Window.partitionBy(*by).orderBy(BLOCK).rowsBetween(Window.unboundedPreceding, -1)

    def last_of_block(c: str) -> Column:
        known = F.col(c).isNotNull()
        if len(order) > 1:
            return F.max_by(c, F.when(known, F.struct(*order)))
        # a plain column, unlike a struct, can be combined in a hash table; its null comes first
        first = F.max_by(c, F.when(known & F.col(order[0]).isNull(), F.lit(1)))
        return F.coalesce(F.max_by(c, F.when(known, F.col(order[0]))), first)

    ends = blocked.where(CUT).groupBy(*by, BLOCK).agg(*[last_of_block(c).alias(c) for c in columns])
    ends = ends.select(
        *by, BLOCK, *[F.last(c, ignorenulls=True).over(earlier).alias(f"_prev_{c}") for c in columns]
    )
    local = blocked.withColumns({c: F.last(c, ignorenulls=True).over(inside) for c in columns})
    return _bring(local, ends, by, blocks).withColumns(
        {c: F.coalesce(F.col(c), F.col(f"_prev_{c}")) for c in columns}
    ).drop(BLOCK, CUT, *[f"_prev_{c}" for c in columns])


def moving(
    df: DataFrame, compute: Callable[[DataFrame, WindowSpec], DataFrame], *, order: Sequence[str],
    by: Sequence[str] = (), before: int = 0, after: int = 0, rows: int = BLOCK_ROWS,
    largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Apply ``compute(df, window)``, whose windows reach ``before``/``after`` rows at most.

    A group over ``rows`` rows is divided into pieces of ``rows``; each piece is given copies of
    the neighbouring rows its windows need, and the copies are dropped from the result. Rows that
    have their position already (``_pos``) are not numbered again.
    """
    largest = largest_group(df, by) if largest is None else largest
    if largest <= rows:
        return compute(df, Window.partitionBy(*by).orderBy(*order))
    if rows <= max(before, after):
        raise ValueError("rows must be larger than the margins")
    placed = df
    if POSITION not in df.columns:
        placed = with_positions(df, order=order, by=by, largest=largest, block_rows=block_rows)
    home = F.floor(F.col(POSITION) / rows)
    offset = F.col(POSITION) % rows
    pieces = F.array_compact(F.array(
        home,
        F.when(offset >= rows - before, home + 1),
        F.when((offset < after) & (home > 0), home - 1),
    ))
    spread = placed.withColumn(PIECE, F.explode(pieces))
    done = compute(spread, Window.partitionBy(*by, PIECE).orderBy(POSITION))
    return done.where(F.col(PIECE) == F.floor(F.col(POSITION) / rows)).drop(PIECE, POSITION)
