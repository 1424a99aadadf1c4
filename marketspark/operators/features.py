"""Price features named in the prompt data: lags, averages, volatility, RSI, MACD, target."""

from __future__ import annotations

import functools
import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketspark.operators.ordering import BLOCK_ROWS, largest_group, last_known, moving

# The feature names as the prompts print them, in prompt order.
PROMPT_LABELS = {
    "lag1_close": "Lag1_ClosePrice",
    "lag3_close": "Lag3_ClosePrice",
    "sma_7": "7-day SMA",
    "sma_30": "30-day SMA",
    "volatility": "Volatility",
    "rsi": "RSI",
    "macd": "MACD",
    "macd_signal": "MACD Signal",
    "sentiment_rolling": "Sentiment Rolling",
}

RSI_ROWS = 14
PRICE_REACH = 30
FADED = 45.0
LARGEST_POWER = 550.0


def _full(value: Column, n: Column, rows: int) -> Column:
    return F.when(n >= rows, value)


def _price_columns(part: DataFrame, w: WindowSpec, price: str) -> DataFrame:
    p = F.col(price)
    week, month, rsi = (w.rowsBetween(1 - n, 0) for n in (7, 30, RSI_ROWS))
    part = part.withColumn("_diff", p - F.lag(p, 1).over(w))
    part = part.select(
        "*",
        F.lag(p, 1).over(w).alias("lag1_close"),
        F.lag(p, 3).over(w).alias("lag3_close"),
        _full(F.avg(p).over(week), F.count(p).over(week), 7).alias("sma_7"),
        _full(F.avg(p).over(month), F.count(p).over(month), 30).alias("sma_30"),
        _full(F.stddev_samp(p).over(month), F.count(p).over(month), 30).alias("volatility"),
        F.sum(F.greatest("_diff", F.lit(0.0))).over(rsi).alias("_gain"),
        F.sum(F.greatest(-F.col("_diff"), F.lit(0.0))).over(rsi).alias("_loss"),
        F.count("_diff").over(rsi).alias("_seen"),
    )
    moved = F.col("_gain") + F.col("_loss")
    return part.withColumn(
        "rsi", F.when((F.col("_seen") >= RSI_ROWS) & (moved > 0), 100 * F.col("_gain") / moved)
    ).drop("_diff", "_gain", "_loss", "_seen")


def price_features(
    df: DataFrame, *, key: str, order: Sequence[str], price: str = "close_price",
    largest: int | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Lags 1 and 3, 7- and 30-row averages, 30-row sample deviation and 14-row RSI."""
    compute = functools.partial(_price_columns, price=price)
    return moving(
        df, compute, by=[key], order=order, before=PRICE_REACH, rows=rows, largest=largest
    )


def _decay(span: int) -> float:
    """How fast a value fades: its weight after n rows is exp(-decay * n)."""
    return -math.log1p(-2 / (span + 1))


def _with_emas(df: DataFrame, averages: Sequence[tuple[str, str, int]], w: WindowSpec) -> DataFrame:
    """Add ``(name, column, span)`` averages with alpha = 2/(span+1), from the first value on.

    With keep = 1 - alpha, value j is keep^j * (x0 + sum of alpha * xi / keep^i): one running sum
    per average, all in one window. The powers stay inside the double range because ``macd``
    limits the rows of a window. ``_j`` numbers the rows with a price, from 0; a row without one
    adds nothing and keeps the last average, and before the first price there is none.
    """
    j = F.col("_j")
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    scaled, results = {}, {}
    for name, column, span in averages:
        if span == 1:
            results[name] = F.col(column).cast("double")
            continue
        share = F.when(j == 0, F.lit(1.0)).otherwise(F.lit(2 / (span + 1)))
        scaled[f"{name}_scaled"] = F.col(column) * share * F.exp(F.lit(_decay(span)) * j)
        results[name] = F.sum(f"{name}_scaled").over(upto) * F.exp(F.lit(-_decay(span)) * j)
    return df.withColumns(scaled).withColumns(results).drop(*scaled)


def _ema_pieces(spans: Sequence[int]) -> tuple[int, int]:
    """(rows, margin): the margin makes an unknown start vanish, the rows keep powers finite."""
    decays = [_decay(s) for s in spans if s > 1] or [1.0]
    margin = math.ceil(FADED / min(decays))
    return math.floor(LARGEST_POWER / max(decays)) - margin, margin


def _numbered(part: DataFrame, w: WindowSpec, column: str) -> DataFrame:
    upto = w.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return part.withColumn("_j", F.count(column).over(upto).cast("double") - 1)


def _macd_columns(
    part: DataFrame, w: WindowSpec, price: str, fast: int, slow: int, signal: int
) -> DataFrame:
    prices = [("_fast", price, fast), ("_slow", price, slow)]
    part = _with_emas(_numbered(part, w, price), prices, w)
    apart = F.col("_fast") - F.col("_slow")
    part = part.withColumns({"macd": apart, "_new": F.when(F.col(price).isNotNull(), apart)}).drop("_fast", "_slow")
    return _with_emas(part, [("macd_signal", "_new", signal)], w).drop("_j", "_new")


def macd(
    df: DataFrame, *, key: str, order: Sequence[str], price: str = "close_price", fast: int = 12,
    slow: int = 26, signal: int = 9, largest: int | None = None,
) -> DataFrame:
    """MACD (fast minus slow average) and its signal average.

    Rows without a price keep the last averages and do not count; before the first price both are
    null. A series longer than a piece starts each piece ``margin`` prices early. By the first row
    kept the weight of the unknown start is below exp(-45), far under double precision.
    """
    same = {"by": [key], "order": order, "largest": largest_group(df, [key]) if largest is None else largest}
    rows, margin = _ema_pieces([fast, slow, signal])
    if same["largest"] > max(rows, 0) and not df.where(F.col(price).isNull()).isEmpty():
        priced = macd(
            df.where(F.col(price).isNotNull()), key=key, order=order, price=price, fast=fast, slow=slow, signal=signal,
            largest=same["largest"],
        )
        gaps = df.where(F.col(price).isNull())
        whole = priced.unionByName(gaps, allowMissingColumns=True)
        return last_known(whole, ["macd", "macd_signal"], **same)
    if rows > margin:
        compute = functools.partial(_macd_columns, price=price, fast=fast, slow=slow, signal=signal)
        return moving(df, compute, before=margin, rows=rows, **same)

    # spans too far apart for common pieces: one average at a time
    def one(part: DataFrame, name: str, column: str, span: int) -> DataFrame:
        def compute(piece: DataFrame, w: WindowSpec) -> DataFrame:
            return _with_emas(_numbered(piece, w, column), [(name, column, span)], w).drop("_j")

        rows, margin = _ema_pieces([span])
        return moving(part, compute, before=margin, rows=rows, **same)

    df = one(one(df, "_fast", price, fast), "_slow", price, slow)
    df = df.withColumn("macd", F.col("_fast") - F.col("_slow")).drop("_fast", "_slow")
    return one(df, "macd_signal", "macd", signal)


def _sentiment_column(part: DataFrame, w: WindowSpec, sentiment: str, span: int) -> DataFrame:
    return part.withColumn("sentiment_rolling", F.avg(sentiment).over(w.rowsBetween(1 - span, 0)))


def sentiment_rolling(
    df: DataFrame, *, key: str, order: Sequence[str], sentiment: str, span: int = 7,
    largest: int | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """Mean sentiment of the last ``span`` rows of the series."""
    compute = functools.partial(_sentiment_column, sentiment=sentiment, span=span)
    return moving(
        df, compute, by=[key], order=order, before=span, rows=rows, largest=largest
    )


def target(
    df: DataFrame, *, key: str, order: Sequence[str], price: str = "close_price",
    largest: int | None = None, rows: int = BLOCK_ROWS,
) -> DataFrame:
    """``bullish`` if the next close is higher, else ``bearish``; null on the last row."""

    def compute(part: DataFrame, w: WindowSpec) -> DataFrame:
        following = F.lead(price, 1).over(w)
        return part.withColumn(
            "target",
            F.when(following > F.col(price), "bullish").when(following.isNotNull(), "bearish"),
        )

    return moving(df, compute, by=[key], order=order, after=1, rows=rows, largest=largest)


def prompt_features(
    df: DataFrame, *, key: str, order: Sequence[str], price: str = "close_price",
    sentiment: str | None = None, largest: int | None = None,
) -> DataFrame:
    """All features of the prompt line, with the default spans, over one shuffle and one sort.

    Only long series with rows without a price take a second pass, for the averages.
    """
    spans = (12, 26, 9)
    rows, margin = _ema_pieces(spans)
    largest = largest_group(df, [key]) if largest is None else largest
    if largest > rows and not df.where(F.col(price).isNull()).isEmpty():
        same = {"key": key, "order": order, "largest": largest}
        out = macd(price_features(df, **same, price=price), **same, price=price)
        return sentiment_rolling(out, **same, sentiment=sentiment) if sentiment else out

    def compute(part: DataFrame, w: WindowSpec) -> DataFrame:
        part = _macd_columns(_price_columns(part, w, price), w, price, *spans)
        return _sentiment_column(part, w, sentiment, 7) if sentiment else part

    return moving(
        df, compute, by=[key], order=order, before=max(margin, PRICE_REACH), rows=rows,
        largest=largest,
    )


def number_text(value: Column, digits: int = 6) -> Column:
    """A plain decimal, rounded, with at least one digit after the point (``1178.3``, ``0.0``)."""
    fixed = F.round(value, digits).try_cast(f"decimal(38,{digits})").cast("string")
    trimmed = F.rtrim(fixed, F.lit("0"))
    plain = F.when(trimmed.endswith("."), F.concat(trimmed, F.lit("0"))).otherwise(trimmed)
    return F.coalesce(plain, value.cast("string"))


def feature_text(
    df: DataFrame, labels: dict[str, str] = PROMPT_LABELS, *, end: str = "", digits: int = 6
) -> Column:
    """``Name: value, Name: value`` over the labelled columns that ``df`` has; nulls are left out."""
    parts = [
        F.concat(F.lit(f"{label}: "), number_text(F.col(name), digits))
        for name, label in labels.items() if name in df.columns
    ]
    return F.concat(F.concat_ws(", ", *parts), F.lit(end))
