"""Market data from landed files to prompt rows."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark import schemas
from marketspark.functions.dates import news_date
from marketspark.operators import features, prompts, reshape
from marketspark.operators.skew import salted_join
from marketspark.sources import files


Jobs = Mapping[str, Sequence[str] | None]


def ingest_history(
    spark: SparkSession, path: str, jobs: Jobs, *, start: str, end: str, as_of: str | None = None,
    skip_bad_files: bool = False,
) -> DataFrame:
    """Histories of all jobs (asset type -> tickers, None for all), put together.

    With ``skip_bad_files`` the run goes on past broken files; ``ingest_errors`` lists them.
    """
    frames = []
    for asset_type, tickers in jobs.items():
        limits = {"start": start, "end": end} if asset_type == schemas.INDEX else {"as_of": as_of}
        frames.append(
            files.read_history(
                spark, path, asset_type=asset_type, tickers=tickers, skip_bad_files=skip_bad_files, **limits
            )
        )
    return reshape.union_all(*frames)


def ingest_errors(
    spark: SparkSession, path: str, jobs: Jobs, history: DataFrame, page_errors: DataFrame | None = None
) -> DataFrame:
    """asset_type, ticker, file, reason: what a tolerant run has left out.

    Files of which no row can be read, tickers that were asked for and have no row in ``history``, and
    the ``page_errors`` (ticker, url, part, error) of ``plans.news``, by page and card.
    """
    asked = [(kind, ticker) for kind, tickers in jobs.items() for ticker in tickers or []]
    named = spark.createDataFrame(asked, "asset_type string, ticker string")
    silent = named.join(history.select("asset_type", "ticker").distinct(), ["asset_type", "ticker"], "left_anti")
    none = F.lit(None).cast("string")
    broken = files.unread_files(spark, path)
    listed = silent.select("asset_type", "ticker", none.alias("file"), F.lit("no rows").alias("reason")).unionByName(
        broken.select(none.alias("asset_type"), none.alias("ticker"), "file", F.lit("not readable").alias("reason"))
    )
    if page_errors is None:
        return listed
    reason = F.concat_ws(" ", F.concat(F.lit("part "), F.col("part"), F.lit(":")), "error")
    return listed.unionByName(page_errors.select(none.alias("asset_type"), "ticker", F.col("url").alias("file"), reason.alias("reason")))


def ingest_options(spark: SparkSession, path: str, jobs: Jobs, *, skip_bad_files: bool = False) -> DataFrame:
    """Long option chains of the stock tickers; other asset types have none."""
    tickers = jobs.get(schemas.STOCK, [])
    wide = files.read_option_chain(spark, path, tickers=tickers, skip_bad_files=skip_bad_files)
    return reshape.tag(reshape.unpivot_chain(wide), asset_type=schemas.STOCK)


def prompt_rows(
    history: DataFrame, *, key: str, order: Sequence[str], price: str, keep: Sequence[str],
    sentiment: str | None = None, largest: int | None = None,
) -> DataFrame:
    """Feature line and evaluation prompt of each history row."""
    rows = features.prompt_features(
        history, key=key, order=order, price=price, sentiment=sentiment, largest=largest
    )
    line = features.feature_text(rows, end=".")
    return rows.select(*keep, line.alias("prompt")).withColumn("text", prompts.eval_text("prompt"))


def daily_sentiment(articles: DataFrame, *, score: str = "score", date: str = "date") -> DataFrame:
    """ticker, trade_date, sentiment: the mean score of a ticker's articles of a day.

    ``date`` is the text of the page; articles without a date or a score are left out.
    """
    dated = articles.select("ticker", news_date(F.col(date)).alias("trade_date"), F.col(score).alias("_score"))
    known = dated.where(F.col("trade_date").isNotNull() & F.col("_score").isNotNull())
    return known.groupBy("ticker", "trade_date").agg(F.avg("_score").alias("sentiment"))


def with_sentiment(history: DataFrame, articles: DataFrame, *, row_key: Sequence[str], score: str = "score") -> DataFrame:
    """History rows with the ``sentiment`` of their ticker and day, null where there is no news."""
    return salted_join(history, daily_sentiment(articles, score=score), ["ticker", "trade_date"], "left", row_key=row_key)


def training_rows(
    history: DataFrame, *, key: str, order: Sequence[str], price: str, keep: Sequence[str] = (),
    instruction: str, sentiment: str | None = None,
) -> DataFrame:
    """instruction, input (the feature line) and response (the next day's label) of each history row.

    The last row of a series has no next day and is left out. ``keep`` names columns to keep in front.
    """
    largest = features.largest_group(history, [key])
    same = {"key": key, "order": order, "price": price, "largest": largest}
    rows = features.prompt_features(features.target(history, **same), **same, sentiment=sentiment)
    line = features.feature_text(rows, end=".")
    labelled = rows.where(F.col("target").isNotNull())
    return labelled.select(*keep, F.lit(instruction).alias("instruction"), line.alias("input"), F.col("target").alias("response"))
