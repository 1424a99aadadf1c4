"""Named queries over the given tables, each with the SQL that must give the same rows.

A query is a function (spark, folder) -> DataFrame registered under a name; ``SQL`` holds the
matching text where plain SQL can say it on whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    def register(function: Query) -> Query:
        QUERIES[name] = function
        if sql is not None:
            SQL[name] = sql
        return function

    return register


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def r6(column: Column | str) -> Column:
    """Six decimals without a negative zero, as the SQL rounds."""
    column = F.col(column) if isinstance(column, str) else column
    return F.round(column, 6) + F.lit(0.0)


def load() -> None:
    """Import the modules that register queries."""
    from marketspark.catalog import cleaning, evaluation, files, market, news, prompts  # noqa: F401
