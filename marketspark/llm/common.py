"""Small helpers of this subpackage: kept tables, words, draws, ranks over groups of any size."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from marketspark.session import remove_path, scratch_path

#: Fixed by the task: words are runs of anything but these ASCII blanks.
WORD = r"[^\x20\x09-\x0D]+"
BLANKS = " \t\n\x0b\x0c\r"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


#: Whether Spark deletes the shuffle files of a query when it has ended.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


@contextlib.contextmanager
def without_leftovers(spark: SparkSession) -> Iterator[None]:
    """Queries that run in this block leave no shuffle files behind."""
    before = spark.conf.get(CLEANUP, None)
    spark.conf.set(CLEANUP, "true")
    try:
        yield
    finally:
        spark.conf.set(CLEANUP, before) if before is not None else spark.conf.unset(CLEANUP)


def kept(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below ``spark.checkpoint.dir`` and read again.

    A lost executor then costs only a read: what was made before is on the shared folder. The shuffle
    files that the write needed go when it is done.
    """
    path = scratch_path(df.sparkSession, name)
    with without_leftovers(df.sparkSession):
        df.write.parquet(path)
    again = df.sparkSession.read.schema(df.schema).parquet(path)
    again.kept_path = path
    return again


def forget(df: DataFrame) -> None:
    """Delete what ``kept`` wrote; for tables that nothing returned reads any more."""
    remove_path(df.sparkSession, df.kept_path)


def give_back() -> None:
    """Hand what a Python worker no longer uses back to the system, where its C library can.

    Workers wait for further tasks with all that they once took, beside an executor that needs the memory.
    """
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):
        ctypes.CDLL(None).malloc_trim(0)


def tidy(task: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """``task`` for ``mapInArrow``, behind which its worker gives memory back."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from task(batches)
        give_back()

    return run


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in parts of ``rows`` rows, for work that holds several copies of its texts."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def unused(df: DataFrame, name: str) -> str:
    """``name``, with signs added until ``df`` has no such column."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


def tokenizer() -> str:
    """The public vocabulary file that queries are given."""
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


def bind(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of ``value``, with ``value`` computed once however often the body names it."""
    return F.transform(F.array(value), body)[0]


def n_words(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def draw(key: Column, seed: int) -> Column:
    """A number in (0, 1) from the key's MD5: the same on every run and in plain SQL."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(key.cast("string"), F.lit("null")))
    number = F.conv(F.substring(F.md5(text), 1, 13), 16, 10).cast("bigint")
    return (number + F.lit(0.5)) / F.lit(float(1 << 52))


def ranked(
    rows: DataFrame, group: Sequence[str], uniform: str, order: Sequence[str], *,
    rank: str, total: str, buckets: int = 1024,
) -> DataFrame:
    """Rank from 0 within the group and the group's size, without one task per group.

    ``uniform`` is a column in [0, 1) by which the rows are spread; it comes first in the order.
    Buckets of it are counted, the counts summed up over at most ``buckets`` rows a group, and
    rows are numbered within their bucket. ``rows`` is read twice and must not change between.
    """
    rows = rows.withColumn("_bucket", F.least(F.floor(F.col(uniform) * buckets), F.lit(buckets - 1)))
    counts = rows.groupBy(*group, "_bucket").agg(F.count(F.lit(1)).alias("_n"))
    whole = Window.partitionBy(*group)
    before = whole.orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    counts = counts.select(
        *[F.col(c).alias(f"_g{i}") for i, c in enumerate(group)], F.col("_bucket").alias("_b"),
        F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"), F.sum("_n").over(whole).alias("_all"),
    )
    condition = F.col("_bucket") == F.col("_b")
    for i, c in enumerate(group):
        condition = condition & F.col(c).eqNullSafe(F.col(f"_g{i}"))
    within = Window.partitionBy(*group, "_bucket").orderBy(uniform, *order)
    numbered = rows.withColumn("_in", F.row_number().over(within) - 1)
    return numbered.join(counts, condition).select(
        *[c for c in rows.columns if c != "_bucket"],
        (F.col("_before") + F.col("_in")).alias(rank), F.col("_all").alias(total),
    )
