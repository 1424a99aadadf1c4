import pandas as pd
import pytest
from pyspark.sql import functions as F

from marketspark.operators import features

KEY = {"key": "ticker", "order": ["ordinal"]}


def prices(spark, values, ticker="A"):
    rows = [(ticker, i, float(v)) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "ticker string, ordinal bigint, close_price double")


def column(df, name):
    return [r[name] for r in df.orderBy("ordinal").collect()]


def test_volatility_and_averages(spark):
    values = [1178.3] * 13 + [487.3] + [1178.3] * 14 + [1451.8, 1178.3]
    out = features.price_features(prices(spark, values), **KEY)
    last = out.orderBy(F.desc("ordinal")).first()
    assert last.volatility == pytest.approx(137.2730781636, abs=1e-8)
    assert last.sma_30 == pytest.approx(sum(values) / 30)
    assert last.sma_7 == pytest.approx(sum(values[-7:]) / 7)
    assert column(out, "volatility")[28] is None and column(out, "sma_7")[5] is None
    assert column(out, "lag3_close")[:4] == [None, None, None, 1178.3]


def test_rsi_edges(spark):
    falling = column(features.price_features(prices(spark, range(20, 0, -1)), **KEY), "rsi")
    flat = column(features.price_features(prices(spark, [5] * 20), **KEY), "rsi")
    assert falling[13] is None and falling[14] == 0.0 and flat[19] is None


def test_macd_by_hand(spark):
    out = features.macd(prices(spark, [10, 11, 9, 12]), **KEY)
    fast = [10, 10.1538461538, 9.9763313609, 10.2876649977]
    slow = pd.Series([10.0, 11, 9, 12]).ewm(span=26, adjust=False).mean()
    assert column(out, "macd") == pytest.approx([f - s for f, s in zip(fast, slow)], abs=1e-9)


@pytest.mark.parametrize("spans", [(12, 26, 9), (2, 60, 1), (3, 400, 5)])
def test_long_series_match_the_recursion(spark, spans):
    fast, slow, signal = spans
    df = spark.range(9000).select(
        F.lit("A").alias("ticker"), F.col("id").alias("ordinal"),
        (100 + F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("close_price"),
    )
    out = features.macd(df, **KEY, fast=fast, slow=slow, signal=signal).orderBy("ordinal").toPandas()
    mean = lambda s, n: s.ewm(span=n, adjust=False).mean()
    line = mean(out.close_price, fast) - mean(out.close_price, slow)
    assert abs(out.macd - line).max() < 1e-9
    assert abs(out.macd_signal - mean(line, signal)).max() < 1e-9


def test_prompt_features_in_pieces(spark):
    df = prices(spark, [100 + (i * 37 % 23) for i in range(200)]).withColumn("mood", F.lit(0.5))
    whole = features.prompt_features(df, **KEY, sentiment="mood")
    parts = features.sentiment_rolling(
        features.price_features(df, **KEY, rows=40), **KEY, sentiment="mood", rows=9
    )
    for name in ("lag1_close", "lag3_close", "sma_7", "sma_30", "volatility", "rsi", "sentiment_rolling"):
        assert column(parts, name) == pytest.approx(column(whole, name), nan_ok=True), name


def test_target(spark):
    assert column(features.target(prices(spark, [1, 2, 2, 1]), **KEY), "target") == ["bullish", "bearish", "bearish", None]


def test_feature_text(spark):
    df = spark.sql("select 1178.3D lag1_close, 1079.585714285706D sma_7, 0.0D rsi, -1.0D macd, "
                   "cast(null as double) volatility, 12345678.25D macd_signal, 1e40D sentiment_rolling")
    text = df.select(features.feature_text(df, end=".").alias("t")).first().t
    assert text == (
        "Lag1_ClosePrice: 1178.3, 7-day SMA: 1079.585714, RSI: 0.0, MACD: -1.0, "
        "MACD Signal: 12345678.25, Sentiment Rolling: 1.0E40."
    )


@pytest.mark.parametrize("long", [False, True])
def test_macd_over_gaps(spark, long, monkeypatch):
    """Rows without a price keep the last averages; the same in one window and in pieces."""
    import random

    rng = random.Random(4)
    values = [None, None, 100.0, *[None if rng.random() < 0.3 else 100 + rng.random() for _ in range(300)]]
    expected, fast, slow, signal = [], None, None, None
    for v in values:
        if v is not None:
            fast = v if fast is None else fast + (v - fast) * 2 / 13
            slow = v if slow is None else slow + (v - slow) * 2 / 27
            signal = fast - slow if signal is None else signal + (fast - slow - signal) * 2 / 10
        expected.append((None, None) if fast is None else (fast - slow, signal))
    df = spark.createDataFrame([("A", i, v) for i, v in enumerate(values)], "ticker string, ordinal bigint, close_price double")
    if long:
        monkeypatch.setattr(features, "FADED", 4.0)
        monkeypatch.setattr(features, "LARGEST_POWER", 20.0)
    found = [(r.macd, r.macd_signal) for r in features.macd(df, key="ticker", order=["ordinal"]).orderBy("ordinal").collect()]
    assert found[:2] == [(None, None)] * 2
    close = 0.2 if long else 1e-9
    for i in (0, 1):
        assert [x[i] for x in found[2:]] == pytest.approx([x[i] for x in expected[2:]], abs=close)
    every = features.prompt_features(df, key="ticker", order=["ordinal"]).orderBy("ordinal").collect()
    assert [(r.macd, r.macd_signal) for r in every[:2]] == [(None, None)] * 2
    assert [r.macd for r in every[2:]] == pytest.approx([m for m, _ in found[2:]], abs=close)


def test_a_constant_price_with_gaps_has_no_macd(spark):
    df = spark.createDataFrame([("A", i, None if i in (0, 3) else 100.0) for i in range(8)], "ticker string, ordinal bigint, close_price double")
    rows = features.macd(df, key="ticker", order=["ordinal"]).orderBy("ordinal").collect()
    assert rows[0].macd is None and [r.macd for r in rows[1:]] == pytest.approx([0.0] * 7, abs=1e-9)
