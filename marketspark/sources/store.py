"""The store by asset type, and the hand-off files."""

from __future__ import annotations

import hashlib
import uuid
from dataclasses import dataclass, replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.operators.news import StoredPages
from marketspark.session import scratch_path


def write_store(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Parquet partitioned by ``asset_type``; each task writes its own rows, so no shuffle."""
    df.write.mode(mode).partitionBy("asset_type").parquet(path)


def read_store(spark: SparkSession, path: str | WindowStore, asset_type: str) -> DataFrame:
    """Rows of one asset type by partition pruning; none for a type that is not there."""
    rows = path.frame(spark) if isinstance(path, WindowStore) else spark.read.parquet(path)
    return rows.where(F.col("asset_type") == asset_type)


@dataclass(frozen=True)
class WindowStore:
    """A store whose rows lie as windows over a series need them.

    Inside the asset type they are bucketed by ``key`` and sorted by ``key`` and ``order``, so that a window by
    ``key`` reads it without a shuffle. ``path`` is a shared folder and all that another session needs.
    """

    path: str
    buckets: int = 200
    key: str = "ticker"
    order: tuple[str, ...] = ("trade_date",)

    @property
    def table(self) -> str:
        return "store_" + hashlib.md5(f"{self.path}|{self.buckets}|{self.key}|{self.order}".encode()).hexdigest()

    def _write(self, df: DataFrame, mode: str) -> None:
        rows = df.repartition(self.buckets, self.key).sortWithinPartitions("asset_type", self.key, *self.order)
        writer = rows.write.mode(mode).format("parquet").partitionBy("asset_type").bucketBy(self.buckets, self.key)
        writer.sortBy(self.key, *self.order).option("path", self.path).saveAsTable(self.table)

    def create(self, df: DataFrame) -> WindowStore:
        """The store with the rows of ``df``, in place of any before."""
        self._write(df, "overwrite")
        return self

    def append(self, df: DataFrame) -> WindowStore:
        """More rows, as further files of their buckets."""
        self.frame(df.sparkSession)
        self._write(df, "append")
        return self

    def frame(self, spark: SparkSession) -> DataFrame:
        """The rows; a session that does not know the table yet is told how it is laid out."""
        if not spark.catalog.tableExists(self.table):
            columns = spark.read.parquet(self.path).schema
            columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in columns)
            by = ", ".join(f"`{c}`" for c in (self.key, *self.order))
            spark.sql(
                f"create table {self.table} ({columns}) using parquet partitioned by (asset_type) "
                f"clustered by (`{self.key}`) sorted by ({by}) into {self.buckets} buckets location '{self.path}'"
            )
            spark.catalog.recoverPartitions(self.table)
        return spark.table(self.table)

    def compact(self, spark: SparkSession, path: str) -> WindowStore:
        """The same rows below ``path``, with one file a bucket and asset type however many appends there were.

        The old files stay until the caller removes them, for readers that still use them. They are read
        as plain files: a bucketed scan would make the shuffle before the write look needless.
        """
        rows = spark.read.schema(self.frame(spark).schema).parquet(self.path)
        return replace(self, path=path).create(rows)


def store_pages(pages: DataFrame, *, buckets: int = 200, path: str | None = None) -> StoredPages:
    """Land ``pages`` (url, html) as a table bucketed and sorted by address, for flows of several hops.

    The pages are shuffled once, here. ``path`` is a shared folder; without it one below
    ``spark.checkpoint.dir`` is taken, which goes with the session.
    """
    spark = pages.sparkSession
    name = f"pages_{uuid.uuid4().hex}"
    rows = pages.select("url", "html").repartition(buckets, "url")
    writer = rows.write.bucketBy(buckets, "url").sortBy("url").option("path", path or scratch_path(spark, name))
    writer.format("parquet").saveAsTable(name)
    return StoredPages(spark.table(name))


def get_data(
    spark: SparkSession, history_path: str | WindowStore, options_path: str | WindowStore, asset_type: str
) -> tuple[DataFrame, DataFrame]:
    """(history, options) of one asset type."""
    return read_store(spark, history_path, asset_type), read_store(spark, options_path, asset_type)


def write_jsonl(df: DataFrame, path: str) -> None:
    """One JSON object per line; null fields are written, so every line has every field."""
    df.write.option("ignoreNullFields", False).json(path)


def write_csv(df: DataFrame, path: str) -> None:
    """Header CSV with doubled quotes; newlines inside a field are kept."""
    df.write.option("header", True).option("quote", '"').option("escape", '"').csv(path)
