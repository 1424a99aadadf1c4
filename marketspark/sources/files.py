"""Readers of landed files: companies, histories, option chains, pages, prompts."""

from __future__ import annotations

import contextlib
import csv
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame, DataFrameReader, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark import schemas
from marketspark.operators.skew import small_side, written

BAD_LINE = "_bad_line"


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """NaN in floating columns (all, or those named) becomes null; one NaN would spoil every average."""
    floating = [
        f.name for f in df.schema
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) and (columns is None or f.name in columns)
    ]
    return df.withColumns({c: F.when(~F.isnan(c), F.col(c)) for c in floating})


def with_ordinal(df: DataFrame, name: str = "ordinal") -> DataFrame:
    """A unique number per row, rising in reading order; use it right after the scan.

    The same files and settings give the same numbers. Write the table when several jobs share
    them as a key.
    """
    return df.withColumn(name, F.monotonically_increasing_id())


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """Company list from XML: ordinal, ticker, ticker_name, cid (all text)."""
    raw = spark.read.format("xml").option("rowTag", "Company").schema(schemas.COMPANIES_XML).load(path)
    return with_ordinal(raw).select(
        "ordinal",
        F.col("Ticker").alias("ticker"),
        F.col("Ticker_Name").alias("ticker_name"),
        F.col("CID").alias("cid"),
    )


def read_jsonl(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """One JSON object per line; a line that does not parse is kept in ``_bad_line``."""
    wide = T.StructType([*schema.fields, T.StructField(BAD_LINE, T.StringType())])
    options = {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": BAD_LINE}
    lines = spark.read.text(path).where(F.trim("value") != "")
    return lines.select(F.from_json("value", wide, options).alias("r")).select("r.*")


def good_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD_LINE).isNull()).drop(BAD_LINE)


def bad_rows(df: DataFrame) -> DataFrame:
    return df.where(F.col(BAD_LINE).isNotNull()).select(F.col(BAD_LINE).alias("line"))


def read_train_jsonl(spark: SparkSession, path: str, *, on_error: str = "raise") -> DataFrame:
    """instruction, input, response of every line; a line that does not parse raises.

    With ``on_error="skip"`` such lines are left out; ``bad_rows(read_jsonl(...))`` lists them.
    """
    if on_error not in ("raise", "skip"):
        raise ValueError("on_error must be raise or skip")
    rows = read_jsonl(spark, path, schemas.TRAIN_JSONL)
    if on_error == "skip":
        return good_rows(rows)
    message = F.concat(F.lit("a line is no JSON object: "), F.col(BAD_LINE))
    parsed = F.when(F.col(BAD_LINE).isNull(), F.lit(True)).otherwise(F.raise_error(message).cast("boolean"))
    return rows.where(parsed).drop(BAD_LINE)


def read_test_csv(spark: SparkSession, path: str) -> DataFrame:
    """prompt and target from header CSV, found by the names in the header, whatever their order.

    Quoted fields may hold newlines. A file is read by one task; ``read_test_csv_split`` reads large
    ones in parallel.
    """
    raw = (
        spark.read.option("header", True).option("multiLine", True).option("quote", '"')
        .option("escape", '"').option("inferSchema", False).csv(path)
    )
    absent = [c for c in schemas.TEST_CSV.names if c not in raw.columns]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in {path}")
    return raw.select(F.col("Prompt").alias("prompt"), F.col("Target").alias("target"))


@contextlib.contextmanager
def _chunks_of(spark: SparkSession, size: int | None) -> Iterator[None]:
    """Scans in this block read files in splits of ``size`` bytes."""
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")
    before = {name: spark.conf.get(name) for name in names} if size else {}
    try:
        for name in before:
            spark.conf.set(name, size)
        yield
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)


def split_records(spark: SparkSession, path: str, *, chunk_bytes: int | None = None) -> DataFrame:
    """file, block, number, record: the records of CSV files, whose quoted fields may hold newlines.

    Each task reads one chunk (a split of a file). Quotes are counted by chunk and their parity summed up
    along the file, so that every chunk knows whether it begins inside a field; a record begins at each
    line with an even number of quotes before it. What a chunk holds of a record that began earlier, and
    its last record, are then put together along the file. Only quoted fields may hold quotes, doubled.
    """
    raw = spark.read.option("lineSep", "\n").text(path)
    lines = raw.select(
        F.regexp_replace("value", r"\r$", "").alias("line"), F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("block"), F.monotonically_increasing_id().alias("n"),
    )
    quotes = F.length("line") - F.length(F.replace("line", F.lit('"'), F.lit("")))
    earlier = Window.partitionBy("file").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    inside = Window.partitionBy("file", "block")
    upto = inside.orderBy("n").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    with _chunks_of(spark, chunk_bytes):
        sums = lines.groupBy("file", "block").agg(F.sum(quotes).alias("q"))
        opening = small_side(sums.select("file", "block", F.coalesce(F.sum("q").over(earlier) % 2, F.lit(0)).alias("odd")))
        known = lines.withColumn("q", quotes).join(opening, ["file", "block"])
        begins = F.when((F.col("odd") + F.sum("q").over(upto) - F.col("q")) % 2 == 0, 1).otherwise(0)
        numbered = known.withColumn("begins", begins).withColumn("number", F.sum("begins").over(upto))
        numbered = numbered.withColumn("last", F.max("number").over(inside))
        pieces = F.transform(F.array_sort(F.collect_list(F.struct("n", "line"))), lambda x: x["line"])
        parts = written(numbered.groupBy("file", "block", "number").agg(F.first("last").alias("last"), F.array_join(pieces, "\n").alias("record")))
    # a chunk's beginning and its last record may belong to records of other chunks
    edge = (F.col("number") == 0) | (F.col("number") == F.col("last"))
    along = Window.partitionBy("file").orderBy("block", "number").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    owner = F.last(F.when(F.col("number") > 0, F.struct("block", "number")), ignorenulls=True).over(along)
    ordered = F.transform(F.array_sort(F.collect_list(F.struct("block", "number", "record"))), lambda x: x["record"])
    edges = parts.where(edge).withColumn("owner", owner).groupBy("file", "owner").agg(F.array_join(ordered, "\n").alias("record"))
    return parts.where(~edge).select("file", "block", "number", "record").unionByName(edges.select("file", "owner.block", "owner.number", "record"))


def read_test_csv_split(spark: SparkSession, path: str, *, chunk_bytes: int | None = None) -> DataFrame:
    """As ``read_test_csv``, with every file read by many tasks; all files have the same header."""
    records = split_records(spark, path, chunk_bytes=chunk_bytes)
    first = (F.col("block") == 0) & (F.col("number") == 1)
    headers = [r["record"] for r in records.where(first).select("record").distinct().limit(2).collect()]
    if len(headers) != 1:
        raise ValueError(f"the files below {path} have {'different headers' if headers else 'no header'}")
    names = next(csv.reader([headers[0]]))
    absent = [c for c in schemas.TEST_CSV.names if c not in names]
    if absent:
        raise ValueError(f"no column {', '.join(absent)} in {path}")
    schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(names))]).toDDL()
    rows = records.where(~first & (F.col("record") != ""))
    fields = rows.select(F.from_csv("record", schema, {"quote": '"', "escape": '"'}).alias("r"))
    return fields.select(F.col(f"r.c{names.index('Prompt')}").alias("prompt"), F.col(f"r.c{names.index('Target')}").alias("target"))


def check_asset_type(asset_type: str, known: Sequence[str] = schemas.ASSET_TYPES) -> str:
    if asset_type not in known:
        raise ValueError(f"unknown asset type {asset_type!r}; known: {', '.join(known)}")
    return asset_type


def in_dates(column: str, start: str | None, end: str | None) -> Column:
    """``start <= column <= end`` for yyyy-MM-dd limits; either side may be open."""
    inside = F.lit(True)
    if start is not None:
        inside = inside & (F.col(column) >= F.lit(start).cast("date"))
    if end is not None:
        inside = inside & (F.col(column) <= F.lit(end).cast("date"))
    return inside


def unread_files(spark: SparkSession, path: str) -> DataFrame:
    """file, bytes of the Parquet files below ``path`` of which not one row can be read.

    What ``skip_bad_files`` leaves out is in this list, and so are files without rows.
    """
    listed = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.parquet")
    listed = listed.load(path).select(F.col("path").alias("file"), F.col("length").alias("bytes"))
    rows = _landed(spark, True).option("recursiveFileLookup", True).parquet(path)
    name = F.regexp_replace(F.url_decode("_metadata.file_path"), "^file:/+", "file:/")
    read = rows.select(name.alias("file")).distinct()
    return listed.withColumn("file", F.regexp_replace(F.url_decode("file"), "^file:/+", "file:/")).join(read, "file", "left_anti")


def _landed(spark: SparkSession, skip_bad_files: bool) -> DataFrameReader:
    """Parquet reader; with ``skip_bad_files`` a broken file counts as empty and the run goes on."""
    return spark.read.option("ignoreCorruptFiles", skip_bad_files)


def read_history(
    spark: SparkSession, path: str, *, asset_type: str, tickers: Sequence[str] | None = None,
    start: str | None = None, end: str | None = None, as_of: str | None = None, months: int = 12,
    skip_bad_files: bool = False,
) -> DataFrame:
    """Landed price history of one asset type.

    Stock and ETF take the last ``months`` months up to ``as_of`` (today), whatever the dates of
    the job, unless a range is given; Index takes the range. One end of a range may be left open.
    """
    check_asset_type(asset_type)
    df = _landed(spark, skip_bad_files).parquet(path).where(F.col("asset_type") == asset_type)
    if tickers is not None:
        df = df.where(F.col("ticker").isin(list(tickers)))
    if start is not None or end is not None:
        return nan_to_null(df.where(in_dates("trade_date", start, end)))
    if asset_type == schemas.INDEX:
        raise ValueError("Index history needs start or end")
    today = F.current_date() if as_of is None else F.lit(as_of).cast("date")
    first = F.add_months(today, -months)
    return nan_to_null(df.where((F.col("trade_date") >= first) & (F.col("trade_date") <= today)))


def read_option_chain(
    spark: SparkSession, path: str, *, tickers: Sequence[str] | None = None,
    skip_bad_files: bool = False,
) -> DataFrame:
    """Landed wide option chains, one row per snapshot and strike; absent greeks read as null."""
    df = _landed(spark, skip_bad_files).schema(schemas.OPTION_CHAIN_WIDE).parquet(path)
    return nan_to_null(df if tickers is None else df.where(F.col("symbol").isin(list(tickers))))


def read_pages(spark: SparkSession, path: str, *, skip_bad_files: bool = False) -> DataFrame:
    """Landed raw pages."""
    return _landed(spark, skip_bad_files).schema(schemas.PAGES).parquet(path)


def empty(spark: SparkSession, schema: T.StructType) -> DataFrame:
    """What a source without data stands for: no rows, full schema."""
    return spark.createDataFrame([], schema)
