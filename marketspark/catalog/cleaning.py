"""Text, gaps, duplicates, numbers, dates and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.catalog import query, r6, table
from marketspark.catalog.market import hot_series, series
from marketspark import schemas
from marketspark.functions import dates, text
from marketspark.operators import cleaning, encoding, evaluation


@query("clean_text", "select doc_id, trim(regexp_replace(text, '\\s+', ' ', 'g')) as clean_text from documents")
def clean_text(spark, folder):
    docs = table(spark, folder, "documents")
    return docs.select("doc_id", text.clean_text(F.col("text")).alias("clean_text"))


@query("news_dedup_first", """
    select doc_id, lang from (select *, row_number() over (partition by lang, text order by doc_id) as n from documents)
    where n = 1
""")
def news_dedup_first(spark, folder):
    docs = table(spark, folder, "documents")
    return cleaning.drop_duplicates_first(docs, ["lang", "text"], order=["doc_id"], wide=True).select("doc_id", "lang")


@query("fill_defaults", """
    select event_id, coalesce(case when event_type <> 'error' then event_type end, 'No Title') as title,
           coalesce(case when event_type <> 'view' then props end, 'No Content') as content from events
""")
def fill_defaults(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id",
        F.when(F.col("event_type") != "error", F.col("event_type")).alias("title"),
        F.when(F.col("event_type") != "view", F.col("props")).alias("content"),
    )
    return cleaning.fill_defaults(rows)


def _gaps(spark, folder, hot=False):
    """Series in which error rows lack the price and click rows lack the type."""
    rows = (hot_series if hot else series)(spark, folder, "event_type")
    return rows.select(
        "ticker", "ts", "event_id",
        F.when(F.col("event_type") != "error", F.col("close_price")).alias("close_price"),
        F.when(F.col("event_type") != "click", F.col("event_type")).alias("kind"),
    )


def _fill_sql(over: str, source: str = "events") -> str:
    frame = "rows between unbounded preceding and current row"
    return f"""
        select event_id,
          last_value(case when event_type <> 'error' then value end ignore nulls) over ({over} {frame}) as close_price,
          last_value(case when event_type <> 'click' then event_type end ignore nulls) over ({over} {frame}) as kind
        from {source}
    """


@query("ffill_series", _fill_sql("partition by user_id order by ts, event_id"))
def ffill_series(spark, folder):
    filled = cleaning.ffill(_gaps(spark, folder), by="ticker", order=["ts", "event_id"])
    return filled.select("event_id", "close_price", "kind")


@query("ffill_hot_series", _fill_sql(
    "partition by case when event_type in ('click', 'view') then -1 else user_id end order by ts, event_id"
))
def ffill_hot_series(spark, folder):
    filled = cleaning.ffill(
        _gaps(spark, folder, hot=True), by="ticker", order=["ts", "event_id"], block_rows=500
    )
    return filled.select("event_id", "close_price", "kind")


@query("ffill_global", _fill_sql("order by ts, event_id"))
def ffill_global(spark, folder):
    filled = cleaning.ffill(
        _gaps(spark, folder), ["close_price", "kind"], scope="global", order=["ts", "event_id"],
        block_rows=500,
    )
    return filled.select("event_id", "close_price", "kind")


@query("parse_amount", "select o_orderkey, round(o_totalprice, 2) as close_price from orders")
def parse_amount(spark, folder):
    rows = table(spark, folder, "orders").select(
        "o_orderkey", F.format_number("o_totalprice", 2).alias("close_price")
    )
    return cleaning.parse_amounts(rows, ["close_price", "not_there"])


@query("parse_amount_or_null", """
    select l_orderkey, l_linenumber,
           case when l_returnflag <> 'R' then round(l_extendedprice, 2) end as close_price from lineitem
""")
def parse_amount_or_null(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "R", "-").otherwise(F.format_number("l_extendedprice", 2)).alias("close_price"),
    )
    return cleaning.parse_amounts(rows, ["close_price"], on_error="null")


def _scaled_sql(column: str, over: str = "") -> str:
    return f"""round(({column} - avg({column}) over ({over}))
        / case when stddev_pop({column}) over ({over}) = 0 then 1 else stddev_pop({column}) over ({over}) end, 6) + 0.0"""


@query("standardize", f"select c_custkey, {_scaled_sql('c_acctbal')} as c_acctbal from customer")
def standardize(spark, folder):
    rows = table(spark, folder, "customer").select("c_custkey", "c_acctbal")
    scaled = encoding.standardize(rows, ["c_acctbal"])
    return scaled.select("c_custkey", r6("c_acctbal").alias("c_acctbal"))


@query("standardize_by_group", f"""
    select o_orderkey, o_orderstatus, {_scaled_sql('o_totalprice', 'partition by o_orderstatus')} as o_totalprice,
           {_scaled_sql('o_custkey', 'partition by o_orderstatus')} as o_custkey from orders
""")
def standardize_by_group(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_totalprice", "o_custkey")
    scaled = encoding.standardize(rows, ["o_totalprice", "o_custkey"], by="o_orderstatus")
    return scaled.select(
        "o_orderkey", "o_orderstatus", r6("o_totalprice").alias("o_totalprice"), r6("o_custkey").alias("o_custkey")
    )


@query("standardize_amounts", f"""
    select l_orderkey, l_linenumber, {_scaled_sql('l_extendedprice')} as close_price,
           {_scaled_sql('l_quantity')} as total_traded_quantity from lineitem
""")
def standardize_amounts(spark, folder):
    rows = table(spark, folder, "lineitem").select(
        "l_orderkey", "l_linenumber", F.format_number("l_extendedprice", 2).alias("close_price"),
        F.col("l_quantity").alias("total_traded_quantity"),
    )
    scaled = cleaning.standardize_amounts(rows, schemas.HISTORY_AMOUNTS)
    return scaled.withColumns({c: r6(c) for c in ("close_price", "total_traded_quantity")})


KINDS = ("click", "error", "purchase", "signup", "view")


@query("one_hot", "select event_id, " + ", ".join(
    f"coalesce(event_type = '{k}' and value >= 5, false) as kind_{k}" for k in KINDS
) + " from events")
def one_hot(spark, folder):
    rows = table(spark, folder, "events").select(
        "event_id", F.when(F.col("value") >= 5, F.col("event_type")).alias("kind")
    )
    return encoding.one_hot(rows, "kind", values=KINDS)


@query("normalize_dates", """
    select event_id, case when event_type <> 'error' then strftime(ts, '%d-%m-%Y') end as date from events
""")
def normalize_dates(spark, folder):
    ts = F.col("ts")
    updated = F.concat(F.lit("Last Updated: "), F.date_format(ts, "MMM d, yyyy, hh:mm:ss a"), F.lit(" IST"))
    iso = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")
    raw = F.when(F.col("event_type") == "error", F.date_format(ts, "yyyy-MM-dd")).when(
        F.col("event_type") == "click", updated
    ).otherwise(iso)
    return table(spark, folder, "events").select("event_id", dates.normalize_date(raw).alias("date"))


@query("label_codes", """
    select event_id, case event_type when 'purchase' then 1 when 'error' then 0 end::int as code from events
""")
def label_codes(spark, folder):
    label = F.when(F.col("event_type") == "purchase", "bullish").when(F.col("event_type") == "error", "bearish")
    return table(spark, folder, "events").select("event_id", evaluation.label_code(label).alias("code"))


NEWS_SQL = """
    with raw as (
        select doc_id, source as ticker, case when lang <> 'de' then lang || '  ' || source end as title,
               case when lang <> 'fr' then text end as content,
               case when n_chars >= 500 then n_chars::varchar end as date from documents
    ), firsts as (
        select *, trim(regexp_replace(coalesce(title, 'None'), '\\s+', ' ', 'g')) as clean_title,
               row_number() over (partition by title, content order by doc_id) as n from raw
    )
    select doc_id, clean_title, coalesce(title, 'No Title') as title, coalesce(content, 'No Content') as content,
           last_value(date ignore nulls) over (partition by ticker order by doc_id
               rows between unbounded preceding and current row) as date
    from firsts where n = 1
"""


@query("preprocess_news", NEWS_SQL)
def preprocess_news(spark, folder):
    rows = table(spark, folder, "documents").select(
        "doc_id", F.col("source").alias("ticker"),
        F.when(F.col("lang") != "de", F.concat("lang", F.lit("  "), "source")).alias("title"),
        F.when(F.col("lang") != "fr", F.col("text")).alias("content"),
        F.when(F.col("n_chars") >= 500, F.col("n_chars").cast("string")).alias("date"),
    )
    return cleaning.clean_news(rows, order=["doc_id"]).drop("ticker")


@query("preprocess_market", """
    select event_id, last_value(case when event_type <> 'error' then value end ignore nulls) over w as close_price,
           coalesce(last_value(case when event_type in ('purchase', 'signup') then event_type end ignore nulls) over w
               = 'purchase', false) as option_type_purchase,
           coalesce(last_value(case when event_type in ('purchase', 'signup') then event_type end ignore nulls) over w
               = 'signup', false) as option_type_signup
    from events
    window w as (partition by user_id order by event_id rows between unbounded preceding and current row)
""")
def preprocess_market(spark, folder):
    kind = F.col("event_type")
    rows = table(spark, folder, "events").select(
        F.col("event_id").alias("ordinal"), F.col("user_id").alias("ticker"),
        F.when(kind != "error", F.col("value")).alias("close_price"),
        F.when(kind.isin("purchase", "signup"), kind).alias("option_type"),
    )
    news = table(spark, folder, "documents").select(
        F.col("doc_id").alias("ordinal"), F.col("source").alias("ticker"), F.col("lang").alias("title"),
        F.col("text").alias("content"), F.lit("x").alias("date"),
    )
    empty = rows.drop("option_type").limit(0)
    stock, _, _, _ = cleaning.preprocess(rows, empty, empty, news, option_values=["purchase", "signup"])
    return stock.drop("ticker").withColumnRenamed("ordinal", "event_id")


FRAMES_SQL = """
    with s as (
        select event_id as ordinal, 'U' || user_id as ticker,
               last_value(case when event_type <> 'error' then floor(value * 100) end ignore nulls) over w as price,
               last_value(case when event_type in ('purchase', 'signup') then event_type end ignore nulls) over w as kind
        from events window w as (partition by user_id order by event_id rows between unbounded preceding and current row)),
    o as (
        select o_orderkey as ordinal, 'T' || o_custkey as ticker, o_orderstatus as status,
               last_value(case when o_orderkey % 3 > 0 then o_totalprice end ignore nulls)
                   over (partition by o_orderstatus, o_custkey order by o_orderkey rows between unbounded preceding and current row) as price
        from orders where o_orderstatus in ('O', 'P')),
    p as (
        select 'stock' as frame, ordinal, ticker, price, kind from s union all
        select case status when 'O' then 'index' else 'etf' end, ordinal, ticker, price, null from o),
    f as (select frame, avg(price) as mean, case when stddev_pop(price) = 0 then 1 else stddev_pop(price) end as scale from p group by 1),
    raw as (
        select doc_id, source as ticker, case when lang <> 'de' then lang || '  ' || source end as title,
               case when lang <> 'fr' then text end as content,
               case when n_chars >= 500 then '2024-01-0' || (doc_id % 9 + 1) || 'T10:00:00.000Z' end as date from documents),
    firsts as (
        select *, trim(regexp_replace(coalesce(title, 'None'), '\\s+', ' ', 'g')) as clean_title,
               row_number() over (partition by title, content order by doc_id) as n from raw)
    select p.frame, ordinal, ticker,
           case when p.frame <> 'index' then round((price - mean) / scale, 6) + 0 end as close_price,
           case when p.frame = 'index' then round((price - mean) / scale, 6) + 0 end as closing_price,
           coalesce(kind = 'purchase', false) as option_type_purchase, coalesce(kind = 'signup', false) as option_type_signup,
           null as title, null as content, null as clean_title, null as date
    from p join f on f.frame = p.frame
    union all
    select 'news', doc_id, ticker, null, null, null, null, coalesce(title, 'No Title'), coalesce(content, 'No Content'), clean_title,
           last_value(case when date is null then null else '0' || date[10] || '-01-2024' end ignore nulls)
               over (partition by ticker order by doc_id rows between unbounded preceding and current row)
    from firsts where n = 1
"""


@query("preprocess_frames", FRAMES_SQL)
def preprocess_frames(spark, folder):
    """All four frames from whole tables, filled together, with scores and dates."""
    kind = F.col("event_type")
    # a grouped number text, as the landed files have it
    price = F.format_number(F.floor(F.col("value") * 100), 0)
    stock = table(spark, folder, "events").select(
        F.col("event_id").alias("ordinal"), F.concat(F.lit("U"), F.col("user_id").cast("string")).alias("ticker"),
        F.when(kind != "error", price).alias("close_price"), F.when(kind.isin("purchase", "signup"), kind).alias("option_type"),
    )
    orders = table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ordinal"), F.concat(F.lit("T"), F.col("o_custkey").cast("string")).alias("ticker"),
        F.when(F.col("o_orderkey") % 3 > 0, F.col("o_totalprice").cast("string")).alias("price"), "o_orderstatus",
    )
    index = orders.where("o_orderstatus = 'O'").drop("o_orderstatus").withColumnRenamed("price", "closing_price")
    etf = orders.where("o_orderstatus = 'P'").drop("o_orderstatus").withColumnRenamed("price", "close_price")
    stamp = F.concat(F.lit("2024-01-0"), (F.col("doc_id") % 9 + 1).cast("string"), F.lit("T10:00:00.000Z"))
    news = table(spark, folder, "documents").select(
        F.col("doc_id").alias("ordinal"), F.col("source").alias("ticker"),
        F.when(F.col("lang") != "de", F.concat("lang", F.lit("  "), "source")).alias("title"),
        F.when(F.col("lang") != "fr", F.col("text")).alias("content"), F.when(F.col("n_chars") >= 500, stamp).alias("date"),
    )
    frames = cleaning.preprocess_frames(
        stock, index, etf, news, option_values=["purchase", "signup"], scores=True, dates=True
    )
    return frames.withColumns({c: r6(c) for c in ("close_price", "closing_price")})


@query("ffill_text_order", """
    select event_id, last_value(case when event_type = 'purchase' then value end ignore nulls)
        over (order by event_type, event_id::varchar rows between unbounded preceding and current row) as value from events
""")
def ffill_text_order(spark, folder):
    """Rows in the order of texts, of which very many begin alike, in small blocks."""
    rows = table(spark, folder, "events").select(
        "event_id", F.concat(F.lit("the same beginning "), "event_type").alias("kind"),
        F.col("event_id").cast("string").alias("name"), F.when(F.col("event_type") == "purchase", F.col("value")).alias("value"),
    )
    filled = cleaning.ffill(rows, ["value"], order=["kind", "name"], scope="global", block_rows=300)
    return filled.select("event_id", "value")


@query("ffill_url_order", """
    select page_id, last_value(case when page_id % 5 = 0 then page_id end ignore nulls)
        over (order by url nulls first, page_id rows between unbounded preceding and current row) as value from pages
""")
def ffill_url_order(spark, folder):
    """Rows in the order of addresses, which share long beginnings, in small blocks."""
    rows = table(spark, folder, "pages").select("page_id", "url", F.when(F.col("page_id") % 5 == 0, F.col("page_id")).alias("value"))
    filled = cleaning.ffill(rows, ["value"], order=["url", "page_id"], scope="global", block_rows=100)
    return filled.select("page_id", "value")


@query("parse_amount_odd", """
    select event_id, case event_type when 'click' then 1234.5 when 'view' then -7.0 when 'purchase' then 0.5 end::double as amount
    from events
""")
def parse_amount_odd(spark, folder):
    """Numbers as Python's float reads them, and texts that it does not read or reads as no number."""
    texts = {"click": "1,234.5", "view": " -7 ", "purchase": ".5e0", "error": "10d", "signup": "nan"}
    text = F.lit("0x10")
    for kind, value in texts.items():
        text = F.when(F.col("event_type") == kind, value).otherwise(text)
    rows = table(spark, folder, "events").select("event_id", text.alias("amount"))
    return cleaning.parse_amounts(rows, ["amount"], on_error="null")


@query("standardize_nan", """
    with v as (select event_id, case when event_type <> 'error' then value end as value from events)
    select event_id, round((value - avg(value) over ()) / stddev_pop(value) over (), 6) + 0.0 as value from v
""")
def standardize_nan(spark, folder):
    value = F.when(F.col("event_type") == "error", float("nan")).otherwise(F.col("value"))
    rows = table(spark, folder, "events").select("event_id", value.alias("value"))
    return encoding.standardize(rows, ["value"]).select("event_id", r6("value").alias("value"))
