"""Histories, option chains and price features."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marketspark.catalog import query, r6, table
from marketspark.catalog.prompts import EVAL_TEXT, filled_sql
from marketspark import schemas
from marketspark.operators import features, reshape
from marketspark.plans import market as plans
from marketspark.session import scratch_path
from marketspark.sources import files, store

KEY = {"key": "ticker", "order": ["ts", "event_id"]}
ASSET_OF_STATUS = {"F": schemas.STOCK, "P": schemas.ETF, "O": schemas.INDEX}


def series(spark: SparkSession, folder: str, *others: Column | str) -> DataFrame:
    """The events as price series: ticker, ts, event_id, close_price."""
    return table(spark, folder, "events").select(
        F.col("user_id").alias("ticker"), "ts", "event_id", F.col("value").alias("close_price"), *others
    )


def hot_series(spark: SparkSession, folder: str, *others: str) -> DataFrame:
    """The same rows with two fifths of them, all clicks and views, under one ticker."""
    hot = F.when(F.col("event_type").isin("click", "view"), F.lit(-1)).otherwise(F.col("user_id"))
    return table(spark, folder, "events").select(
        hot.cast("bigint").alias("ticker"), "ts", "event_id", F.col("value").alias("close_price"), *others
    )


def _orders(spark: SparkSession, folder: str) -> DataFrame:
    status = F.col("o_orderstatus")
    asset = F.lit(None).cast("string")
    for code, name in ASSET_OF_STATUS.items():
        asset = F.when(status == code, name).otherwise(asset)
    return table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ordinal"),
        F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
        asset.alias("asset_type"),
        F.col("o_orderdate").cast("date").alias("trade_date"),
        F.col("o_totalprice").alias("price"),
    )


@query("history_tagged_union", """
    select o_orderkey as ordinal, o_totalprice as close_price, null::double as closing_price, 'Stock' as asset_type
      from orders where o_orderstatus = 'F' and o_orderdate between date '2000-01-01' and date '2001-01-01'
    union all
    select o_orderkey, o_totalprice, null, 'ETF'
      from orders where o_orderstatus = 'P' and o_orderdate between date '2000-01-01' and date '2001-01-01'
    union all
    select o_orderkey, null, o_totalprice, 'Index'
      from orders where o_orderstatus = 'O' and o_orderdate between date '1996-01-01' and date '1998-12-31'
""")
def history_tagged_union(spark, folder):
    rows = _orders(spark, folder)

    def part(asset_type, start, end, price):
        chosen = rows.where((F.col("asset_type") == asset_type) & files.in_dates("trade_date", start, end))
        return reshape.tag(chosen.select("ordinal", F.col("price").alias(price)), asset_type=asset_type)

    year = ("2000-01-01", "2001-01-01")
    return reshape.union_all(
        part(schemas.STOCK, *year, "close_price"),
        part(schemas.ETF, *year, "close_price"),
        part(schemas.INDEX, "1996-01-01", "1998-12-31", "closing_price"),
    )


@query("history_by_asset", """
    select o_orderkey as ordinal, 'T' || o_custkey as ticker, o_totalprice as price, 'ETF' as asset_type
    from orders where o_orderstatus = 'P'
""")
def history_by_asset(spark, folder):
    path = scratch_path(spark, "history")
    store.write_store(_orders(spark, folder), path)
    history, _ = store.get_data(spark, path, path, schemas.ETF)
    return history.select("ordinal", "ticker", "price", "asset_type")


@query("asset_data", """
    with o as (select o_orderkey, 'T' || o_custkey % 200 as ticker, o_orderdate::date as d, o_totalprice as price from orders where o_orderstatus = 'P')
    select 'history' as side, o_orderkey as ordinal, ticker, d as trade_date, price,
           case when row_number() over w >= 7 then round(avg(price) over (w rows between 6 preceding and current row), 6) end as sma_7, null::bigint as strike
    from o window w as (partition by ticker order by d, o_orderkey)
    union all
    select 'options', l_orderkey, 'T' || l_suppkey % 200, null, l_extendedprice, null, l_linenumber::bigint from lineitem where l_returnflag = 'A'
""")
def asset_data(spark, folder):
    """Both halves of an asset type from stores laid out for windows, after an append and a compaction."""
    orders = _orders(spark, folder).withColumn("ticker", F.concat(F.lit("T"), F.pmod(F.substring("ticker", 2, 20).cast("bigint"), F.lit(200)).cast("string")))
    orders = orders.select("ordinal", "ticker", "asset_type", "trade_date", F.col("price").alias("close_price"))
    history = store.WindowStore(scratch_path(spark, "series"), buckets=16, order=("trade_date", "ordinal"))
    history.create(orders.where("ordinal % 3 > 0")).append(orders.where("ordinal % 3 = 0"))
    history = history.compact(spark, scratch_path(spark, "series"))
    kind = F.when(F.col("l_returnflag") == "A", schemas.ETF).otherwise(schemas.STOCK)
    chains = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ordinal"), F.concat(F.lit("T"), (F.col("l_suppkey") % 200).cast("string")).alias("ticker"),
        kind.alias("asset_type"), F.col("l_extendedprice").alias("price"), F.col("l_linenumber").cast("bigint").alias("strike"),
    )
    options = store.WindowStore(scratch_path(spark, "chains"), buckets=16, order=("ordinal", "strike")).create(chains)
    rows, chain = store.get_data(spark, history, options, schemas.ETF)
    rows = features.price_features(rows, key="ticker", order=["trade_date", "ordinal"])
    rows = rows.select("ordinal", "ticker", "trade_date", F.col("close_price").alias("price"), r6("sma_7").alias("sma_7"))
    return reshape.union_all(reshape.tag(rows, side="history"), reshape.tag(chain.drop("asset_type"), side="options"))


@query("history_source", """
    select o_orderkey as ordinal, 'T' || o_custkey as ticker, o_totalprice as price,
           case o_orderstatus when 'F' then 'Stock' when 'P' then 'ETF' else 'Index' end as asset_type
    from orders
    where (o_orderstatus in ('F', 'P') and o_orderdate between date '2000-06-30' and date '2001-06-30')
       or (o_orderstatus = 'O' and o_orderdate between date '1996-01-01' and date '1998-12-31')
""")
def history_source(spark, folder):
    path = scratch_path(spark, "landed-history")
    _orders(spark, folder).write.parquet(path)
    jobs = {schemas.STOCK: None, schemas.ETF: None, schemas.INDEX: None}
    return plans.ingest_history(
        spark, path, jobs, start="1996-01-01", end="1998-12-31", as_of="2001-06-30"
    ).select("ordinal", "ticker", "price", "asset_type")


CHAIN_COLUMNS = {
    "symbol": "l_orderkey", "strike_price": "l_linenumber", "calls_ltp": "l_extendedprice",
    "puts_ltp": "l_quantity", "calls_iv": "l_discount", "puts_iv": "l_tax",
    "calls_oi": "l_partkey", "puts_oi": "l_suppkey", "calls_volume": "l_quantity",
    "puts_volume": "l_linenumber",
}


def _wide_chain(spark: SparkSession, folder: str) -> DataFrame:
    lines = table(spark, folder, "lineitem")
    text = {"symbol"}
    return lines.select(
        F.date_format("l_shipdate", "dd-MM-yyyy").alias("fetch_time"),
        F.lit("28-12-2001").alias("expiry_date"),
        *[
            F.col(source).cast("string" if name in text else "double").alias(name)
            for name, source in CHAIN_COLUMNS.items()
        ],
    )


CHAIN_SQL = """
    with wide as (select strftime(l_shipdate, '%d-%m-%Y') as date, l_orderkey::varchar as ticker,
                         l_linenumber::double as strike_price, '28-12-2001' as expiry_date, * from lineitem)
    select date, ticker, strike_price, expiry_date, 'call' as option_type, l_extendedprice as option_close_price,
           l_discount as implied_volatility, l_partkey::double as open_interest, l_quantity as volume,
           null::double as delta, null::double as gamma, null::double as theta, null::double as vega from wide
    union all
    select date, ticker, strike_price, expiry_date, 'put', l_quantity, l_tax, l_suppkey::double,
           l_linenumber::double, null, null, null, null from wide
"""


@query("chain_unpivot", CHAIN_SQL)
def chain_unpivot(spark, folder):
    return reshape.unpivot_chain(_wide_chain(spark, folder))


@query("chain_source", f"select *, 'Stock' as asset_type from ({CHAIN_SQL})")
def chain_source(spark, folder):
    path = scratch_path(spark, "landed-chain")
    _wide_chain(spark, folder).write.parquet(path)
    return plans.ingest_options(spark, path, {schemas.STOCK: None, schemas.INDEX: None})


@query("history_join_options", """
    select o_orderkey as ticker, o_totalprice as price, l_linenumber::bigint as strike, l_extendedprice as option_price
    from orders left join lineitem on o_orderkey = l_orderkey
""")
def history_join_options(spark, folder):
    history = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticker"), F.col("o_totalprice").alias("price")
    )
    options = table(spark, folder, "lineitem").select(
        F.col("l_orderkey").alias("ticker"), F.col("l_linenumber").cast("bigint").alias("strike"),
        F.col("l_extendedprice").alias("option_price"),
    )
    return reshape.history_join_options(
        history, options, on=["ticker"]
    )


@query("history_join_options_hot", """
    select o_orderkey as ticker, o_totalprice as price, l_linenumber::bigint as strike, l_extendedprice as option_price
    from orders left join (select case when l_linenumber <= 2 then 1 else l_orderkey end as k, * from lineitem)
      on o_orderkey = k
""")
def history_join_options_hot(spark, folder):
    history = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ticker"), F.col("o_totalprice").alias("price")
    )
    options = table(spark, folder, "lineitem").select(
        F.when(F.col("l_linenumber") <= 2, F.lit(1)).otherwise(F.col("l_orderkey")).cast("bigint").alias("ticker"),
        F.col("l_linenumber").cast("bigint").alias("strike"),
        F.col("l_extendedprice").alias("option_price"),
    )
    return reshape.history_join_options(
        history, options, on=["ticker"], rows=1000
    )


def _series_sql(columns: str, source: str = "events") -> str:
    return f"""
        with series as (select *, value - lag(value) over (partition by user_id order by ts, event_id) as diff from {source})
        select event_id, {columns} from series
        window w as (partition by user_id order by ts, event_id),
               w7 as (partition by user_id order by ts, event_id rows between 6 preceding and current row),
               w14 as (partition by user_id order by ts, event_id rows between 13 preceding and current row),
               w30 as (partition by user_id order by ts, event_id rows between 29 preceding and current row)
    """


GAINS, LOSSES = "sum(greatest(diff, 0)) over w14", "sum(greatest(-diff, 0)) over w14"
FEATURE_SQL = {
    "lag1_close": "lag(value, 1) over w",
    "lag3_close": "lag(value, 3) over w",
    "sma_7": "case when count(value) over w7 >= 7 then avg(value) over w7 end",
    "sma_30": "case when count(value) over w30 >= 30 then avg(value) over w30 end",
    "volatility": "case when count(value) over w30 >= 30 then stddev_samp(value) over w30 end",
    "rsi": f"""case when count(diff) over w14 >= 14 and {GAINS} + {LOSSES} > 0
        then 100 * {GAINS} / ({GAINS} + {LOSSES}) end""",
    "sentiment_rolling": """avg(case event_type when 'purchase' then 1.0::double when 'error' then -1.0 else 0.0 end)
        over w7""",
}
TARGET_SQL = """case when lead(value) over w > value then 'bullish'
    when lead(value) over w is not null then 'bearish' end as target"""


def _feature_sql(*names: str) -> str:
    """The features, rounded to six decimals."""
    return ", ".join(f"round({FEATURE_SQL[n]}, 6) + 0.0 as {n}" for n in names)


HOT_EVENTS = "(select * replace (case when event_type in ('click', 'view') then -1 else user_id end as user_id) from events)"
PRICE_COLUMNS = ("lag1_close", "lag3_close", "sma_7", "sma_30", "volatility", "rsi")


def _price(spark, folder, *columns):
    out = features.price_features(series(spark, folder), **KEY)
    return out.select("event_id", *[r6(c).alias(c) for c in columns])


@query("feat_lags", _series_sql(_feature_sql("lag1_close", "lag3_close")))
def feat_lags(spark, folder):
    return _price(spark, folder, "lag1_close", "lag3_close")


@query("feat_sma", _series_sql(_feature_sql("sma_7", "sma_30")))
def feat_sma(spark, folder):
    return _price(spark, folder, "sma_7", "sma_30")


@query("feat_volatility", _series_sql(_feature_sql("volatility")))
def feat_volatility(spark, folder):
    return _price(spark, folder, "volatility")


@query("feat_rsi", _series_sql(_feature_sql("rsi")))
def feat_rsi(spark, folder):
    return _price(spark, folder, "rsi")


@query("feat_hot_series", _series_sql(_feature_sql(*PRICE_COLUMNS) + ", " + TARGET_SQL, HOT_EVENTS))
def feat_hot_series(spark, folder):
    rows = features.price_features(hot_series(spark, folder), **KEY, rows=500)
    rows = features.target(rows, **KEY, rows=500)
    return rows.select("event_id", *[r6(c).alias(c) for c in PRICE_COLUMNS], "target")


MACD_CTE = """
    with recursive s as (
        select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as rn from events
    ), m as (
        select user_id, event_id, rn, value as e12, value as e26, 0.0::double as sig from s where rn = 1
        union all
        select s.user_id, s.event_id, s.rn,
               m.e12 * 11 / 13 + s.value * 2 / 13, m.e26 * 25 / 27 + s.value * 2 / 27,
               m.sig * 0.8 + 0.2 * ((m.e12 * 11 / 13 + s.value * 2 / 13) - (m.e26 * 25 / 27 + s.value * 2 / 27))
        from m join s on s.user_id = m.user_id and s.rn = m.rn + 1
    )"""


@query("feat_macd", MACD_CTE + """
    select event_id, round(e12 - e26, 6) + 0.0 as macd, round(sig, 6) + 0.0 as macd_signal from m
""")
def feat_macd(spark, folder):
    return features.macd(series(spark, folder), **KEY).select(
        "event_id", r6("macd").alias("macd"), r6("macd_signal").alias("macd_signal")
    )


def with_mood(spark, folder):
    """Series with the mood of each row's event type."""
    mood = F.when(F.col("event_type") == "purchase", 1.0).when(F.col("event_type") == "error", -1.0).otherwise(0.0)
    return series(spark, folder, mood.alias("sentiment"))


@query("feat_sentiment", _series_sql(_feature_sql("sentiment_rolling")))
def feat_sentiment(spark, folder):
    rows = features.sentiment_rolling(with_mood(spark, folder), **KEY, sentiment="sentiment")
    return rows.select("event_id", r6("sentiment_rolling").alias("sentiment_rolling"))


@query("feat_target", _series_sql(TARGET_SQL))
def feat_target(spark, folder):
    return features.target(series(spark, folder), **KEY).select("event_id", "target")


def _text(column: str, digits: int = 3) -> str:
    return f"regexp_replace(round({column}, {digits})::decimal(38, {digits})::varchar, '(\\.\\d+?)0+$', '\\1')"


PROMPT_SQL = _series_sql(", ".join(f"{sql} as {n}" for n, sql in FEATURE_SQL.items()))


@query("feat_prompt", MACD_CTE + f""",
    f as ({PROMPT_SQL})
    select event_id, concat_ws(', ',
        'Lag1_ClosePrice: ' || {_text('lag1_close')}, 'Lag3_ClosePrice: ' || {_text('lag3_close')},
        '7-day SMA: ' || {_text('sma_7')}, '30-day SMA: ' || {_text('sma_30')},
        'Volatility: ' || {_text('volatility')}, 'RSI: ' || {_text('rsi')},
        'MACD: ' || {_text('e12 - e26')}, 'MACD Signal: ' || {_text('sig')},
        'Sentiment Rolling: ' || {_text('sentiment_rolling')}) || '.' as prompt
    from f join m using (event_id)
""")
def feat_prompt(spark, folder):
    rows = features.prompt_features(with_mood(spark, folder), **KEY, price="close_price", sentiment="sentiment")
    return rows.select("event_id", features.feature_text(rows, end=".", digits=3).alias("prompt"))


LINE_SQL = f"""concat_ws(', ',
    'Lag1_ClosePrice: ' || {_text('lag1_close', 6)}, 'Lag3_ClosePrice: ' || {_text('lag3_close', 6)},
    '7-day SMA: ' || {_text('sma_7', 6)}, '30-day SMA: ' || {_text('sma_30', 6)},
    'Volatility: ' || {_text('volatility', 6)}, 'RSI: ' || {_text('rsi', 6)},
    'MACD: ' || {_text('e12 - e26', 6)}, 'MACD Signal: ' || {_text('sig', 6)},
    'Sentiment Rolling: ' || {_text('sentiment_rolling', 6)}) || '.'"""


@query("prompt_rows", MACD_CTE + f""",
    f as ({PROMPT_SQL}), p as (select user_id as ticker, event_id, {LINE_SQL} as prompt from f join m using (event_id))
    select ticker, event_id, prompt, {filled_sql(EVAL_TEXT, 'prompt')} as text from p
""")
def prompt_rows(spark, folder):
    rows = with_mood(spark, folder)
    return plans.prompt_rows(rows, **KEY, price="close_price", sentiment="sentiment", keep=["ticker", "event_id"])


TRAIN_SQL = _series_sql(", ".join([*[f"{sql} as {n}" for n, sql in FEATURE_SQL.items()], TARGET_SQL]))


@query("training_rows", MACD_CTE + f""",
    f as ({TRAIN_SQL})
    select event_id, 'Predict.' as instruction, {LINE_SQL} as input, target as response
    from f join m using (event_id) where target is not null
""")
def training_rows(spark, folder):
    rows = with_mood(spark, folder)
    return plans.training_rows(
        rows, **KEY, price="close_price", sentiment="sentiment", instruction="Predict.", keep=["event_id"]
    )


GAPS = "(select * replace (case when event_type <> 'error' and event_id % 5 > 0 then value end as value) from events)"


@query("feat_macd_gaps", """
    with recursive e as (select * from %s), s as (
        select user_id, event_id, value, row_number() over (partition by user_id order by ts, event_id) as rn
        from e where value is not null
    ), m as (
        select user_id, event_id, rn, value as e12, value as e26, 0.0::double as sig from s where rn = 1
        union all
        select s.user_id, s.event_id, s.rn,
               m.e12 * 11 / 13 + s.value * 2 / 13, m.e26 * 25 / 27 + s.value * 2 / 27,
               m.sig * 0.8 + 0.2 * ((m.e12 * 11 / 13 + s.value * 2 / 13) - (m.e26 * 25 / 27 + s.value * 2 / 27))
        from m join s on s.user_id = m.user_id and s.rn = m.rn + 1
    )
    select event_id, round(last_value(e12 - e26 ignore nulls) over w, 6) + 0.0 as macd,
           round(last_value(sig ignore nulls) over w, 6) + 0.0 as macd_signal
    from e left join m using (event_id)
    window w as (partition by e.user_id order by ts, event_id rows between unbounded preceding and current row)
""" % GAPS)
def feat_macd_gaps(spark, folder):
    """Prices that are missing at the beginning of a series and inside it."""
    priced = (F.col("event_type") != "error") & (F.col("event_id") % 5 > 0)
    rows = series(spark, folder, "event_type").withColumn("close_price", F.when(priced, F.col("close_price")))
    return features.macd(rows, **KEY).select("event_id", r6("macd").alias("macd"), r6("macd_signal").alias("macd_signal"))


@query("daily_sentiment", """
    select 'T' || user_id as ticker, cast(ts as date) as trade_date, avg(value) as sentiment from events
    where event_type <> 'error' and value is not null group by 1, 2
""")
def daily_sentiment(spark, folder):
    """Scored articles of each ticker, their date as the text of a page; errors have none."""
    page_date = F.concat(F.lit("Last Updated: "), F.date_format("ts", "MMM d, yyyy, hh:mm:ss a"), F.lit(" IST"))
    articles = table(spark, folder, "events").select(
        F.concat(F.lit("T"), F.col("user_id").cast("string")).alias("ticker"), F.col("value").alias("score"),
        F.when(F.col("event_type") != "error", page_date).alias("date"),
    )
    return plans.daily_sentiment(articles)
