"""Standard scores and one-hot columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.operators.ordering import keyed_join
from marketspark.operators.skew import small_side
from marketspark.sources.files import nan_to_null


def _fit(columns: Sequence[str]) -> list[Column]:
    scale = {c: F.stddev_pop(c) for c in columns}
    return [F.avg(c).alias(f"_mean_{c}") for c in columns] + [
        F.when(sd == 0, F.lit(1.0)).otherwise(sd).alias(f"_scale_{c}") for c, sd in scale.items()
    ]


def standardize(df: DataFrame, columns: Sequence[str], *, by: str | None = None) -> DataFrame:
    """(x - mean) / population deviation, a zero deviation counting as 1; nulls and NaN become null.

    One narrow aggregate fits all columns. Over the whole frame it is a scalar subquery, so the
    rows are not shuffled; ``by`` fits each group and joins the few fitted rows back.
    """
    columns = list(columns)
    if not columns:
        return df
    df = nan_to_null(df, columns)
    if by is None:
        fitted = df.agg(F.struct(*_fit(columns))).scalar()
        return df.withColumns({
            c: (F.col(c) - fitted[f"_mean_{c}"]) / fitted[f"_scale_{c}"] for c in columns
        })
    fits = small_side(df.groupBy(by).agg(*_fit(columns)))
    return keyed_join(df, fits, [by]).withColumns({
        c: (F.col(c) - F.col(f"_mean_{c}")) / F.col(f"_scale_{c}") for c in columns
    }).drop(*[f"_{kind}_{c}" for c in columns for kind in ("mean", "scale")])


def categories(df: DataFrame, column: str) -> DataFrame:
    """Sorted distinct non-null values: collect them for ``one_hot`` where they are few."""
    return df.where(F.col(column).isNotNull()).select(column).distinct().orderBy(column)


def one_hot(df: DataFrame, column: str, *, values: Sequence) -> DataFrame:
    """Replace ``column`` by one boolean per value, sorted, at the end; null is false everywhere.

    The caller names the values, so that the columns do not depend on the rows; ``categories``
    lists those of a table.
    """
    if column not in df.columns:
        return df
    flags = [
        F.coalesce(F.col(column) == F.lit(v), F.lit(False)).alias(f"{column}_{v}") for v in sorted(values)
    ]
    return df.select(*[c for c in df.columns if c != column], *flags)
