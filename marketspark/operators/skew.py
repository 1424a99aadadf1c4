"""Joins and small lookups that stay safe when one key holds a large share of the rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.operators.ordering import BLOCK_ROWS, keyed_join
from marketspark.session import shared_folder

SMALL_ROWS = 100_000
SMALL_BYTES = 64 << 20
HOT_KEYS = 1_000_000
SAMPLED = 1000
MAX_SALTS = 10_000
#: Bits of a filter: 32 megabytes.
FILTER_BITS = 1 << 28
SALT = "_salt"
COPIES = "_copies"


def written(df: DataFrame) -> DataFrame:
    """``df`` computed once and kept in the shared folder, for work that passes over it again."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def bounded(df: DataFrame, max_rows: int = SMALL_ROWS) -> tuple[DataFrame, bool]:
    """``df`` written once and measured, and whether it has at most ``max_rows`` rows and SMALL_BYTES of text.

    A side that small is marked for broadcast; a larger one is left to another way of joining.
    """
    kept = written(df)
    texts = [f.name for f in kept.schema if isinstance(f.dataType, (T.StringType, T.BinaryType))]
    size = sum((F.coalesce(F.octet_length(F.col(c)), F.lit(0)) for c in texts), F.lit(0).cast("bigint"))
    rows, length = kept.agg(F.count(F.lit(1)), F.coalesce(F.sum(size), F.lit(0))).first()
    small = rows <= max_rows and length <= SMALL_BYTES
    return (F.broadcast(kept) if small else kept), small


def small_side(df: DataFrame, max_rows: int = SMALL_ROWS) -> DataFrame:
    """``df`` marked for broadcast if it is within the bound, else left as it is."""
    return bounded(df, max_rows)[0]


def hot_keys(df: DataFrame, on: Sequence[str], *, rows: int = BLOCK_ROWS) -> DataFrame | None:
    """Keys of about ``rows`` rows or more with the number of salts for each, or None.

    Counted on one of n rows, drawn by a hash of the row's place in its task: copies of a row count like
    any others, and rows that come in turns (four links a page) are all met, which every n-th row would
    not do. Written once: it decides only how rows are spread.
    """
    every = max(1, rows // SAMPLED)
    sample = df.select(*on)
    if every > 1:
        sample = sample.where(F.pmod(F.xxhash64(F.monotonically_increasing_id()), F.lit(every)) == 0)
    sizes = sample.groupBy(*on).agg((F.count(F.lit(1)) * every).alias("_n")).where(F.col("_n") >= rows)
    salts = F.least(F.floor(F.col("_n") / rows) + 1, F.lit(MAX_SALTS).cast("bigint"))
    hot, small = bounded(sizes.select(*on, salts.alias(COPIES)), HOT_KEYS)
    return None if small and hot.isEmpty() else hot


def hash_bits(df: DataFrame, on: Sequence[str], bits: int = FILTER_BITS) -> DataFrame:
    """A filter of the keys in ``df`` as rows (part, bits): ``bits`` bits altogether, however many keys."""
    place = F.pmod(F.xxhash64(*on), F.lit(bits)) + 1
    places = df.select(place.alias("p"))
    return written(places.groupBy(F.bitmap_bucket_number("p").alias("_part")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("p")).alias("_bits")))


def maybe_among(df: DataFrame, on: Sequence[str], filter_rows: DataFrame, bits: int = FILTER_BITS) -> DataFrame:
    """Rows whose key may be one of those behind ``filter_rows`` (from ``hash_bits``, which is broadcast)."""
    place = (F.pmod(F.xxhash64(*on), F.lit(bits)) + 1).alias("p")
    position = F.bitmap_bit_position(place)
    octet = F.conv(F.hex(F.substring("_bits", (position / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    found = df.join(F.broadcast(filter_rows), F.bitmap_bucket_number(place) == F.col("_part"))
    return found.where(F.getbit(octet, (position % 8).cast("int")) == 1).drop("_part", "_bits")


def salted_join(
    left: DataFrame, right: DataFrame, on: Sequence[str], how: str = "inner", *,
    row_key: Sequence[str] | None = None, rows: int = BLOCK_ROWS, hot: DataFrame | None = None,
    partitions: int | None = None,
) -> DataFrame:
    """``left`` join ``right`` (inner or left) with the hot keys of ``left`` spread over salts.

    Rows of a hot key get a salt from the hash of ``row_key``, columns that tell rows apart such
    as an ordinal (all columns by default), so that a rerun of a lost task gives the same salt.
    The ``right`` rows of that key, which should be few, are repeated once per salt. Other keys
    are joined as they are.

    With ``partitions`` both sides are dealt over that many, which Spark then does not put together by
    their bytes: for rows that are few bytes and much work.
    """
    def dealt(df: DataFrame, keys: Sequence[str]) -> DataFrame:
        return df.repartition(partitions, *keys) if partitions else df

    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    row_key = row_key or left.columns
    hot = hot_keys(left, on, rows=rows) if hot is None else hot
    if hot is None:
        return dealt(left, on).join(dealt(right, on), list(on), how)
    spread = keyed_join(left, hot, on).withColumn(
        SALT, F.coalesce(F.pmod(F.xxhash64(*row_key), F.col(COPIES)), F.lit(0))
    ).drop(COPIES)
    repeated = keyed_join(right, hot, on).withColumn(
        SALT, F.explode(F.sequence(F.lit(0), F.coalesce(F.col(COPIES), F.lit(1)) - 1))
    ).drop(COPIES)
    keys = [*on, SALT]
    return dealt(spread, keys).join(dealt(repeated, keys), keys, how).drop(SALT)
