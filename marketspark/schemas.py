"""Schemas of the landed data sets, in snake_case."""

from __future__ import annotations

from pyspark.sql import types as T

# Asset types of the job list and what each one brings.
STOCK, ETF, INDEX = "Stock", "ETF", "Index"
ASSET_TYPES = (STOCK, ETF, INDEX)


_TYPES = {
    "string": T.StringType(), "bigint": T.LongType(), "double": T.DoubleType(), "date": T.DateType(),
}


def _schema(text: str) -> T.StructType:
    """``name type, name type`` without needing a session."""
    pairs = (field.split() for field in text.split(","))
    return T.StructType([T.StructField(name, _TYPES[kind]) for name, kind in pairs])


# XML elements of the company list; the CID stays text to keep leading zeros.
COMPANIES_XML = _schema("Ticker string, Ticker_Name string, CID string")

PRICE_HISTORY = _schema(
    "ordinal bigint, ticker string, asset_type string, trade_date date, "
    "close_price string, total_traded_quantity string"
)
INDEX_HISTORY = _schema(
    "ordinal bigint, ticker string, asset_type string, trade_date date, closing_price string, "
    "tot_traded_qty string, open_int string, settle_price string, option_type string"
)
CHAIN_FIELDS = {
    "option_close_price": "ltp",
    "implied_volatility": "iv",
    "open_interest": "oi",
    "volume": "volume",
    "delta": "delta",
    "gamma": "gamma",
    "theta": "theta",
    "vega": "vega",
}
OPTIONAL_FIELDS = ("delta", "gamma", "theta", "vega")
CHAIN_SIDES = {"call": "calls_", "put": "puts_"}
OPTION_CHAIN_WIDE = _schema(
    "fetch_time string, symbol string, strike_price double, expiry_date string, "
    + ", ".join(
        f"{prefix}{field} double" for prefix in CHAIN_SIDES.values() for field in CHAIN_FIELDS.values()
    )
)
PAGES = _schema("page_id bigint, url string, html string")
NEWS_ARTICLES = _schema(
    "ordinal bigint, url string, title string, date string, content string, ticker string"
)
TRAIN_JSONL = _schema("instruction string, input string, response string")
TEST_CSV = _schema("Prompt string, Target string")

HISTORY_AMOUNTS = (
    "close_price", "total_traded_quantity", "open_interest", "option_close_price",
    "implied_volatility",
)
INDEX_AMOUNTS = ("closing_price", "tot_traded_qty", "open_int", "settle_price")
