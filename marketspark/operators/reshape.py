"""Tags, unions, optional columns and the option-chain unpivot."""

from __future__ import annotations

import functools
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.operators.ordering import BLOCK_ROWS
from marketspark.operators.skew import hot_keys, salted_join
from marketspark.schemas import CHAIN_FIELDS, CHAIN_SIDES, OPTIONAL_FIELDS


def tag(df: DataFrame, **constants) -> DataFrame:
    """Constant columns, such as ``ticker`` or ``asset_type``."""
    return df.withColumns({name: F.lit(value) for name, value in constants.items()})


def union_all(*frames: DataFrame) -> DataFrame:
    """Rows of all frames, columns matched by name, absent ones null, copies kept."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def with_optional(df: DataFrame, columns: Mapping[str, str]) -> DataFrame:
    """Add each column of ``name -> type`` that is absent, as null."""
    absent = {c: F.lit(None).cast(kind) for c, kind in columns.items() if c not in df.columns}
    return df.withColumns(absent)


def existing(df: DataFrame, columns: Sequence[str]) -> list[str]:
    """Those of ``columns`` that ``df`` has."""
    return [c for c in columns if c in df.columns]


def unpivot_chain(
    df: DataFrame, *, keys: Mapping[str, str] | None = None,
    sides: Mapping[str, str] = CHAIN_SIDES, fields: Mapping[str, str] = CHAIN_FIELDS,
    optional: Sequence[str] = OPTIONAL_FIELDS,
) -> DataFrame:
    """Each strike row becomes one row per side, call first.

    ``keys`` maps output to input columns that both sides share; ``fields`` maps output columns
    to what follows the side prefix. A narrow projection: nothing is shuffled.
    """
    keys = keys or {
        "date": "fetch_time", "ticker": "symbol", "strike_price": "strike_price",
        "expiry_date": "expiry_date",
    }

    def source(prefix: str, name: str, field: str) -> Column:
        column = f"{prefix}{field}"
        if column not in df.columns and name in optional:
            return F.lit(None).cast("double")
        return F.col(column)

    def value(name: str, field: str) -> Column:
        result = F.lit(None)
        for side, prefix in sides.items():
            result = F.when(F.col("_side") == side, source(prefix, name, field)).otherwise(result)
        return result.alias(name)

    # a field chosen by side, not an array of structs, so that unused input columns are not read
    doubled = df.withColumn("_side", F.explode(F.array(*[F.lit(side) for side in sides])))
    return doubled.select(
        *[F.col(c).alias(n) for n, c in keys.items()], F.col("_side").alias("option_type"),
        *[value(n, f) for n, f in fields.items()],
    )


def history_join_options(
    history: DataFrame, options: DataFrame, *, on: Sequence[str] = ("ticker", "trade_date"),
    option_key: Sequence[str] | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Every history row with its option rows, or with nulls. ``history`` is unique over ``on``.

    The option rows are the side that can be hot. If they are, they are spread over salts
    (by ``option_key``, columns that tell option rows apart, all by default), and
    history rows without options are found apart, by an anti join with the distinct keys.
    Columns are those of ``history``, then the other ones of ``options``.
    """
    on = list(on)
    columns = [*history.columns, *[c for c in options.columns if c not in on]]
    hot = hot_keys(options, on, rows=rows)
    if hot is None:
        return history.join(options, on, "left").select(*columns)
    matched = salted_join(options, history, on, "inner", row_key=option_key, rows=rows, hot=hot)
    alone = history.join(options.select(*on).distinct(), on, "left_anti")
    return alone.unionByName(matched, allowMissingColumns=True).select(*columns)
