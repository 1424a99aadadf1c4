"""Gap filling, duplicates, number text and the cleaning of the four frames."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.functions.dates import normalize_date
from marketspark.functions.text import amount, as_text, clean_text
from marketspark.operators.encoding import one_hot, standardize
from marketspark.operators.ordering import BLOCK_ROWS, last_known
from marketspark.operators.reshape import existing, tag, union_all
from marketspark.operators.skew import bounded
from marketspark.schemas import HISTORY_AMOUNTS, INDEX_AMOUNTS

# What stands for a missing title or body.
NEWS_DEFAULTS = {"title": "No Title", "content": "No Content"}


def ffill(
    df: DataFrame, columns: Sequence[str] | None = None, *, order: Sequence[str], by: str | None = None,
    scope: str = "group", largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Nulls take the latest earlier value, per ``by`` or over the whole frame (``scope="global"``).

    Leading nulls stay. Without ``columns`` every column but the keys is filled.
    """
    if scope not in ("group", "global"):
        raise ValueError("scope must be group or global")
    if scope == "group" and by is None:
        raise ValueError("scope group needs by")
    keys = [by] if scope == "group" else []
    columns = [c for c in df.columns if c not in {*keys, *order}] if columns is None else list(columns)
    return last_known(df, columns, order=order, by=keys, largest=largest, block_rows=block_rows)


def fill_defaults(df: DataFrame, defaults: Mapping[str, object] = NEWS_DEFAULTS) -> DataFrame:
    """Constants for nulls."""
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(v)) for c, v in defaults.items()})


def parse_amounts(df: DataFrame, columns: Sequence[str], *, on_error: str = "raise") -> DataFrame:
    """Comma-grouped number text to double, for the listed columns that exist and are text."""
    text = [c for c in existing(df, columns) if isinstance(df.schema[c].dataType, T.StringType)]
    return df.withColumns({c: amount(F.col(c), on_error) for c in text})


def _identity(columns: Sequence[str]) -> Column:
    """SHA-256 of the key values; a null differs from every text, and lengths keep values apart."""
    marked = [
        F.when(F.col(c).isNull(), F.lit("-")).otherwise(
            F.concat(F.length(F.col(c).cast("string")).cast("string"), F.lit(":"), F.col(c).cast("string"))
        )
        for c in columns
    ]
    return F.sha2(F.concat_ws("|", *marked), 256)


def _firsts_of_copies(marked: DataFrame, order: Sequence[str]) -> DataFrame | None:
    """The order values of the first row of each digest that several rows have, marked for broadcast.

    None if there are too many for that, or if rows with equal order values leave open which is first.
    """
    each = marked.groupBy("_digest", *order).agg(F.count(F.lit(1)).alias("_n"))
    first = F.min(F.struct(*order)).alias("_first")
    copies = each.groupBy("_digest").agg(first, F.sum("_n").alias("_n"), F.max("_n").alias("_most")).where(F.col("_n") > 1)
    copies, small = bounded(copies.select("_digest", "_first", "_most"))
    if not small or not copies.where(F.col("_most") > 1).isEmpty():
        return None
    return copies.drop("_most")


def drop_duplicates_first(df: DataFrame, keys: Sequence[str], *, order: Sequence[str], wide: bool = False) -> DataFrame:
    """The first row, by ``order``, of each combination of ``keys``; null equals null.

    Rows are compared by the digest of their keys, so sorting does not move over long texts, and
    Spark keeps one row per digest and task before the shuffle: many copies make no hot task.

    ``wide`` rows stay where they are: digests and order values alone are shuffled, and what they say of the
    rows that have copies, which are few next to all, is broadcast. Where they are not few, or order values
    are not unique, rows are shuffled as above.
    """
    marked = df.withColumn("_digest", _identity(keys))
    firsts = _firsts_of_copies(marked, order) if wide else None
    if firsts is not None:
        joined = marked.join(firsts, "_digest", "left")
        return joined.where(F.col("_first").isNull() | F.struct(*order).eqNullSafe(F.col("_first"))).drop("_digest", "_first")
    first = Window.partitionBy("_digest").orderBy(*order)
    numbered = marked.withColumn("_n", F.row_number().over(first))
    return numbered.where(F.col("_n") == 1).drop("_digest", "_n")


def standardize_amounts(
    df: DataFrame, columns: Sequence[str], *, by: str | None = None, on_error: str = "raise"
) -> DataFrame:
    """Those of ``columns`` that exist, as numbers and then as standard scores of this frame."""
    parsed = parse_amounts(df, columns, on_error=on_error)
    return standardize(parsed, existing(parsed, columns), by=by)


def clean_news(
    news: DataFrame, *, order: Sequence[str], by: str | None = "ticker", scope: str = "group",
    dates: bool = False, largest: int | None = None,
) -> DataFrame:
    """Clean title, first of each (title, content), then the fills, in that order.

    The clean title is taken before the fills, so a missing title reads ``None`` there. With
    ``dates`` the page dates become ``dd-MM-yyyy`` text before they are filled.
    """
    dated = ffill(_titled_news(news, order, dates), ["date"], order=order, by=by, scope=scope, largest=largest)
    return fill_defaults(dated)


def _titled_news(news: DataFrame, order: Sequence[str], dates: bool) -> DataFrame:
    """News with a clean title, the first of each (title, content), dates as text; nothing filled yet."""
    titled = news.withColumn("clean_title", clean_text(as_text(F.col("title"))))
    unique = drop_duplicates_first(titled, ["title", "content"], order=order, wide=True)
    return unique.withColumn("date", normalize_date(F.col("date"))) if dates else unique


def preprocess_frames(
    stock: DataFrame, index: DataFrame, etf: DataFrame, news: DataFrame, *,
    order: Sequence[str] = ("ordinal",), by: str = "ticker", scope: str = "group",
    option_values: Sequence[str], scores: bool = False, dates: bool = False,
    largest: int | None = None, block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """The four frames of ``preprocess`` as one, told apart by ``frame``: stock, index, etf, news.

    They are put together first, so that one shuffle and one sort fill them all, and one narrow
    aggregate fits the scores of each frame. What a frame does not have is null in it.
    """
    if scope not in ("group", "global"):
        raise ValueError("scope must be group or global")
    prices = {"stock": (stock, HISTORY_AMOUNTS), "index": (index, INDEX_AMOUNTS), "etf": (etf, HISTORY_AMOUNTS)}
    keys = ["frame", by] if scope == "group" else ["frame"]
    filled = dict.fromkeys(c for df, _ in prices.values() for c in df.columns if c not in {by, *order})
    frames = [tag(df, frame=name) for name, (df, _) in prices.items()]
    whole = union_all(*frames, tag(_titled_news(news, order, dates), frame="news"))
    whole = last_known(whole, [*filled, *({"date"} - set(filled))], order=list(order), by=keys, largest=largest, block_rows=block_rows)
    is_news = F.col("frame") == "news"
    if scores:
        amounts = [c for c in dict.fromkeys((*HISTORY_AMOUNTS, *INDEX_AMOUNTS)) if c in filled]
        scored = standardize_amounts(whole.withColumns({f"_own_{c}": F.col(c) for c in amounts}), amounts, by="frame")
        own = {c: F.col("frame").isin([n for n, (df, listed) in prices.items() if c in listed and c in df.columns]) for c in amounts}
        own_value = {c: F.col(f"_own_{c}") for c in amounts}
        kinds = dict(scored.dtypes)
        whole = scored.withColumns({
            c: F.when(own[c], F.col(c)).otherwise(own_value[c].try_cast(kinds[c])) for c in amounts
        }).drop(*[f"_own_{c}" for c in amounts])
    whole = one_hot(whole, "option_type", values=option_values)
    flags = {c: F.when(~is_news, F.col(c)) for c in whole.columns if c.startswith("option_type_")}
    return whole.withColumns(flags | {c: F.when(is_news, F.coalesce(F.col(c), F.lit(v))).otherwise(F.col(c)) for c, v in NEWS_DEFAULTS.items()})


def preprocess(
    stock: DataFrame, index: DataFrame, etf: DataFrame, news: DataFrame, *,
    order: Sequence[str] = ("ordinal",), by: str = "ticker", scope: str = "group",
    option_values: Sequence[str], scores: bool = False, dates: bool = False,
) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """The four frames cleaned: news as in ``clean_news``, the others filled and one-hot encoded.

    ``option_values`` are the option types that become columns, the same for every frame.
    ``scores`` also turns the amounts of each frame into standard scores.
    """
    frames = []
    for frame, amounts in ((stock, HISTORY_AMOUNTS), (index, INDEX_AMOUNTS), (etf, HISTORY_AMOUNTS)):
        frame = ffill(frame, order=list(order), by=by, scope=scope)
        if scores:
            frame = standardize_amounts(frame, amounts)
        frames.append(one_hot(frame, "option_type", values=option_values))
    return (*frames, clean_news(news, order=list(order), by=by, scope=scope, dates=dates))
