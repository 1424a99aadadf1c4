import re

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketspark.functions import dates, text
from marketspark.operators import cleaning, encoding


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first().r


def test_first_of_each_duplicate(spark):
    rows = [(1, None, "a"), (2, None, "a"), (3, "x", "a"), (4, "x", "a"), (5, "", "a"), (6, "x|1:a", None), (7, "x", "|1:a")]
    df = spark.createDataFrame(rows, "ordinal bigint, title string, content string").repartition(3)
    out = cleaning.drop_duplicates_first(df, ["title", "content"], order=["ordinal"])
    assert sorted(r.ordinal for r in out.collect()) == [1, 3, 5, 6, 7]
    assert out.columns == df.columns


@pytest.mark.parametrize("scope,expected", [("global", [None, 1, 1, 2, 2, 3]), ("group", [None, 1, 1, 2, None, 3])])
@pytest.mark.parametrize("block_rows", [2, 1000])
def test_forward_fill(spark, scope, expected, block_rows):
    values = zip(range(6), "AAAABB", [None, 1, None, 2, None, 3])
    df = spark.createDataFrame(list(values), "ordinal bigint, ticker string, v bigint")
    out = cleaning.ffill(df, ["v"], order=["ordinal"], by="ticker", scope=scope, block_rows=block_rows)
    assert [r.v for r in out.orderBy("ordinal").collect()] == expected


def test_amounts(spark):
    df = spark.createDataFrame([("1,234.5", 2.0), (None, None)], "price string, volume double")
    assert [tuple(r) for r in cleaning.parse_amounts(df, ["price", "volume", "gone"]).collect()] == [(1234.5, 2.0), (None, None)]
    bad = spark.createDataFrame([("-",)], "price string")
    assert cleaning.parse_amounts(bad, ["price"], on_error="null").first().price is None
    with pytest.raises(Exception, match="could not convert"):
        cleaning.parse_amounts(bad, ["price"]).collect()


@pytest.mark.parametrize("ansi", ["true", "false"])
def test_bad_amounts_raise_without_ansi_mode_too(spark, ansi):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        with pytest.raises(Exception, match="could not convert"):
            cleaning.parse_amounts(spark.createDataFrame([("1.x",)], "price string"), ["price"]).collect()
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_standard_scores(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (4.0, 5.0), (None, None)], "a double, b double")
    rows = encoding.standardize(df, ["a", "b"]).collect()
    assert [r.a for r in rows[:3]] == pytest.approx([(x - 7 / 3) / 1.2472191289 for x in (1, 2, 4)])
    assert [r.b for r in rows] == [0.0, 0.0, 0.0, None] and rows[3].a is None


def test_one_hot(spark):
    df = spark.createDataFrame([("put", 1), (None, 2), ("call", 3)], "option_type string, x int")
    out = encoding.one_hot(df, "option_type", values=[r[0] for r in encoding.categories(df, "option_type").collect()])
    assert out.columns == ["x", "option_type_call", "option_type_put"]
    assert [tuple(r) for r in out.collect()] == [(1, False, True), (2, False, False), (3, True, False)]
    assert encoding.one_hot(df, "absent", values=["x"]) is df
    assert encoding.one_hot(df.limit(0), "option_type", values=["b", "a"]).columns == ["x", "option_type_a", "option_type_b"]


@pytest.mark.parametrize("raw,value", [
    ("1,234.5", 1234.5), (" 7 ", 7.0), ("-.5", -0.5), ("1e3", 1000.0), ("+2.", 2.0), ("nan", None), ("-NaN", None), ("inf", float("inf")),
    ("-Infinity", float("-inf")), (None, None),
])
def test_amounts_that_are_numbers(spark, raw, value):
    df = spark.createDataFrame([(raw,)], "v string")
    assert cleaning.parse_amounts(df, ["v"]).first().v == value


@pytest.mark.parametrize("raw", ["10d", "1f", "0x10", "", ".", "e5", "1 2", "one"])
def test_amounts_that_are_no_numbers(spark, raw):
    df = spark.createDataFrame([(raw,)], "v string")
    assert cleaning.parse_amounts(df, ["v"], on_error="null").first().v is None
    with pytest.raises(Exception, match="could not convert"):
        cleaning.parse_amounts(df, ["v"]).collect()


def test_one_nan_does_not_spoil_standard_scores(spark):
    df = spark.createDataFrame([(1.0,), (3.0,), (float("nan"),)], "v double")
    assert [r.v for r in encoding.standardize(df, ["v"]).collect()] == [-1.0, 1.0, None]


def test_clean_text_example(spark):
    assert one(spark, "  a  b\n\tc\x1cd　", text.clean_text) == "a b c d"


@settings(max_examples=10, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.text(alphabet=" \t\n\r\x0b\x0c\x1c\x1d\x1e\x1f\x85\xa0  ​ab", max_size=12), min_size=1, max_size=30))
def test_white_space_is_that_of_python(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string")
    rows = df.select("i", text.clean_text(F.col("v")).alias("c"), text.strip(F.col("v")).alias("s")).collect()
    for r in rows:
        assert r.c == re.sub(r"\s+", " ", values[r.i]).strip()
        assert r.s == values[r.i].strip()


@pytest.mark.parametrize("zone", ["UTC", "America/New_York"])
@pytest.mark.parametrize("raw,expected", [
    ("Last Updated: Aug 5, 2024, 03:07:12 PM IST", "05-08-2024"),
    ("Last Updated: Dec 31, 2023, 11:59:59 PM IST", "31-12-2023"),
    ("2024-08-05T10:11:12.5Z", "05-08-2024"),
    ("2024-8-5T1:1:1.123456Z", "05-08-2024"),
    ("2024-08-05T10:11:12Z", None),
    ("Last Updated: 2024-08-05T10:11:12.5Z", None),
    ("junk", None), ("", None), (None, None),
])
def test_dates(spark, zone, raw, expected):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert one(spark, raw, dates.normalize_date) == expected
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_the_four_frames(spark):
    stock = spark.createDataFrame(
        [(1, "A", "1", "call"), (2, "A", None, None), (3, "B", None, "put")],
        "ordinal bigint, ticker string, close_price string, option_type string",
    )
    plain = stock.drop("option_type")
    news = spark.createDataFrame(
        [(1, "A", None, "x", "d1"), (2, "A", "t\n 1", None, None), (3, "A", None, "x", "d3"), (4, "B", "t", "y", None)],
        "ordinal bigint, ticker string, title string, content string, date string",
    )
    stock, index, etf, cleaned = cleaning.preprocess(stock, plain, plain, news, option_values=["call", "put"])
    rows = {r.ordinal: r for r in stock.collect()}
    assert rows[2].close_price == "1" and rows[2].option_type_call and rows[3].close_price is None
    assert index.columns == etf.columns == ["ordinal", "ticker", "close_price"]
    found = {r.ordinal: (r.clean_title, r.title, r.content, r.date) for r in cleaned.collect()}
    assert found == {
        1: ("None", "No Title", "x", "d1"), 2: ("t 1", "t\n 1", "No Content", "d1"), 4: ("t", "t", "y", None),
    }


def test_the_optional_steps(spark):
    stock = spark.createDataFrame([(1, "A", "1,000"), (2, "A", "3,000")], "ordinal bigint, ticker string, close_price string")
    index = spark.createDataFrame([(1, "N", "5", "put")], "ordinal bigint, ticker string, open_int string, option_type string")
    news = spark.createDataFrame(
        [(1, "A", "t", "x", "2024-08-05T10:11:12.5Z"), (2, "A", "u", "y", "junk")],
        "ordinal bigint, ticker string, title string, content string, date string",
    )
    stock, index, _, news = cleaning.preprocess(
        stock, index, stock, news, option_values=["put"], scores=True, dates=True
    )
    assert [r.close_price for r in stock.orderBy("ordinal").collect()] == [-1.0, 1.0]
    assert tuple(index.first()) == (1, "N", 0.0, True)
    assert [r.date for r in news.orderBy("ordinal").collect()] == ["05-08-2024", "05-08-2024"]


def test_frames_without_the_columns_pass(spark):
    df = spark.range(3)
    assert cleaning.standardize_amounts(df, ["close_price"]).collect() == df.collect()
    assert cleaning.ffill(df, order=["id"], scope="global") is df


@pytest.mark.parametrize("unique", [True, False])
def test_wide_rows_without_copies_stay_where_they_are(spark, tmp_path, unique):
    rows = [(i if unique else 0, i % 3 if i % 5 else None, None if i % 7 == 0 else f"text {i % 9}" if i < 90 else "hot") for i in range(200)]
    spark.createDataFrame(rows, "ordinal int, title int, content string").repartition(4).write.parquet(str(tmp_path / "n"))
    df = spark.read.parquet(str(tmp_path / "n"))
    keys = ["title", "content"]
    plain = cleaning.drop_duplicates_first(df, keys, order=["ordinal"])
    wide = cleaning.drop_duplicates_first(df, keys, order=["ordinal"], wide=True)
    assert sorted(map(tuple, wide.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)
    text = wide._jdf.queryExecution().optimizedPlan().toString()
    assert ("Window" not in text) == unique
    if unique:
        assert "Exchange hashpartitioning" not in wide._jdf.queryExecution().executedPlan().toString()


def test_many_copies_of_wide_rows_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(cleaning, "bounded", lambda df: (df, False))
    df = spark.range(100).select("id", (F.col("id") % 10).alias("t"))
    assert sorted(r["id"] for r in cleaning.drop_duplicates_first(df, ["t"], order=["id"], wide=True).collect()) == list(range(10))


def test_frames_together_equal_frames_alone(spark):
    stock = spark.createDataFrame(
        [(1, "A", "1,000", "call"), (2, "A", None, None), (3, "B", None, "put"), (4, "B", "7", None)],
        "ordinal bigint, ticker string, close_price string, option_type string",
    )
    index = spark.createDataFrame([(1, "A", "5"), (2, "A", None), (3, "N", "9")], "ordinal bigint, ticker string, closing_price string")
    etf = spark.createDataFrame([(1, "A", None), (2, "A", "3")], "ordinal bigint, ticker string, close_price string")
    news = spark.createDataFrame(
        [(1, "A", "t  1", None, "2024-08-05T10:11:12.000Z"), (2, "A", None, "c", None), (3, "A", "t  1", None, None)],
        "ordinal bigint, ticker string, title string, content string, date string",
    )
    values = ["call", "put"]
    for block_rows in (1, 500_000):
        whole = cleaning.preprocess_frames(stock, index, etf, news, option_values=values, scores=True, dates=True, block_rows=block_rows)
        alone = cleaning.preprocess(stock, index, etf, news, option_values=values, scores=True, dates=True)
        for name, frame in zip(("stock", "index", "etf", "news"), alone):
            own = whole.where(whole["frame"] == name).select(*frame.columns)
            assert sorted(map(tuple, own.collect()), key=repr) == sorted(map(tuple, frame.collect()), key=repr), name
