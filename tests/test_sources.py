import csv
import datetime
import random

import pytest
from pyspark.sql import functions as F

from marketspark import schemas
from marketspark.operators import prompts, reshape
from marketspark.plans import evaluation
from marketspark.plans import market as plans
from marketspark.session import scratch_path, shared_folder
from marketspark.sources import files, store


def write(tmp_path, name, text):
    path = tmp_path / name
    path.write_text(text, encoding="utf-8")
    return str(path)


def test_companies(spark, tmp_path):
    path = write(tmp_path, "c.xml", """<?xml version='1.0' encoding='utf-8'?><All>
        <Company><Ticker>M&amp;M</Ticker><Ticker_Name>m-ltd</Ticker_Name><CID>0012</CID></Company>
        <Company><Ticker>B</Ticker><Ticker_Name>b-ltd</Ticker_Name><CID>7</CID></Company></All>""")
    rows = files.read_companies(spark, path).orderBy("ordinal").collect()
    assert [tuple(r)[1:] for r in rows] == [("M&M", "m-ltd", "0012"), ("B", "b-ltd", "7")]


def test_jsonl_with_broken_lines(spark, tmp_path):
    path = write(tmp_path, "t.jsonl", '{"instruction": "i", "input": "a\\nb", "response": "bullish"}\n\n{"instruc\n{"input": "x"}\n')
    good = files.read_train_jsonl(spark, path, on_error="skip")
    assert [tuple(r) for r in good.collect()] == [("i", "a\nb", "bullish"), (None, "x", None)]
    with pytest.raises(Exception, match="no JSON"):
        files.read_train_jsonl(spark, path).collect()
    assert [r.line for r in files.bad_rows(files.read_jsonl(spark, path, schemas.TRAIN_JSONL)).collect()] == ['{"instruc']


def test_training_set_from_landed_lines(spark):
    path = scratch_path(spark, "lines")
    rows = spark.range(50).select(
        F.lit("do").alias("instruction"), F.col("id").cast("string").alias("input"),
        F.when(F.col("id") % 5 == 0, "bullish").otherwise("bearish").alias("response"),
    )
    store.write_jsonl(rows.repartition(3), path)
    landed = files.with_ordinal(files.read_train_jsonl(spark, path))
    balanced, test = evaluation.training_set(landed, eos="</s>", key=["ordinal"])
    sizes = {r.response: r["count"] for r in balanced.groupBy("response").count().collect()}
    assert test.count() == 10 and sizes["bullish"] == sizes["bearish"] >= 20
    assert balanced.join(test, "text").count() == 0


def test_csv_with_newlines_and_quotes(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'Prompt,Target\n"a, ""b""\n\nc",bullish\nplain,bearish\n')
    assert [tuple(r) for r in files.read_test_csv(spark, path).collect()] == [('a, "b"\n\nc', "bullish"), ("plain", "bearish")]


@pytest.mark.parametrize("chunk_bytes", [7, 40, 300, None])
def test_csv_in_chunks_equals_the_whole_file(spark, tmp_path, chunk_bytes):
    rng = random.Random(chunk_bytes)
    cells = ["", "a", '"', '""', "\n", "\n\n", ",", "x, y", 'say "so"', "é日本", "one long text without any end " * 3, "\n" * 30, '"\n"']
    for name in ("a.csv", "b.csv"):
        rows = [(str(i), "".join(rng.choice(cells) for _ in range(rng.randrange(5))), rng.choice(["bullish", "bearish"])) for i in range(60)]
        with open(tmp_path / name, "w", newline="") as out:
            writer = csv.writer(out, lineterminator="\n")
            writer.writerows([("Number", "Prompt", "Target"), *rows])
    whole = files.read_test_csv(spark, str(tmp_path))
    split = files.read_test_csv_split(spark, str(tmp_path), chunk_bytes=chunk_bytes)
    assert split.columns == whole.columns
    assert sorted(map(tuple, split.collect()), key=repr) == sorted(map(tuple, whole.collect()), key=repr)
    if chunk_bytes:
        blocks = files.split_records(spark, str(tmp_path), chunk_bytes=chunk_bytes).select("file", "block").distinct().count()
        assert blocks > 4


def test_csv_with_windows_line_ends_and_one_header(spark, tmp_path):
    path = write(tmp_path, "t.csv", 'Target,Prompt\r\nbullish,"a\r\nb"\r\nbearish,c\r\n')
    assert [tuple(r) for r in files.read_test_csv_split(spark, path, chunk_bytes=9).collect()] == [("a\nb", "bullish"), ("c", "bearish")]
    write(tmp_path, "u.csv", "Prompt,Target\nx,y\n")
    with pytest.raises(ValueError):
        files.read_test_csv_split(spark, str(tmp_path))
    with pytest.raises(ValueError):
        files.read_test_csv_split(spark, write(tmp_path, "w.csv", "Prompt,other\nx,y\n"))


def test_csv_by_name(spark, tmp_path):
    path = write(tmp_path, "t.csv", ',Target,Prompt\n0,bullish,"a\nb"\n1,bearish,c\n')
    assert [tuple(r) for r in files.read_test_csv(spark, path).collect()] == [("a\nb", "bullish"), ("c", "bearish")]
    with pytest.raises(ValueError, match="Target"):
        files.read_test_csv(spark, write(tmp_path, "u.csv", "Prompt,target2\nx,y\n"))


@pytest.fixture(scope="module")
def history(spark):
    path = scratch_path(spark, "history")
    rows = [
        (1, "A", "Stock", datetime.date(2024, 1, 10), 1.0), (2, "A", "Stock", datetime.date(2022, 1, 10), 2.0),
        (3, "B", "ETF", datetime.date(2023, 6, 1), float("nan")), (4, "N", "Index", datetime.date(2020, 1, 1), 4.0),
        (5, "N", "Index", datetime.date(2020, 2, 1), 5.0),
    ]
    df = spark.createDataFrame(rows, "ordinal bigint, ticker string, asset_type string, trade_date date, close_price double")
    store.write_store(df, path)
    return path


def ordinals(df):
    return sorted(r.ordinal for r in df.collect())


def test_history_windows(spark, history):
    read = lambda **k: files.read_history(spark, history, **k)
    assert ordinals(read(asset_type="Stock", as_of="2024-02-01")) == [1]
    assert ordinals(read(asset_type="Stock", start="2022-01-01", end="2022-12-31")) == [2]
    assert ordinals(read(asset_type="Index", start="2020-01-01", end="2020-01-31")) == [4]
    assert ordinals(read(asset_type="Stock", start="2024-01-01")) == [1]
    assert ordinals(read(asset_type="Stock", end="2023-01-01")) == [2]
    assert ordinals(read(asset_type="Index", start="2020-01-15")) == [5]
    assert ordinals(read(asset_type="Stock", tickers=["Z"], as_of="2024-02-01")) == []
    assert read(asset_type="ETF", as_of="2024-01-01").first().close_price is None
    with pytest.raises(ValueError):
        read(asset_type="Bond")
    with pytest.raises(ValueError):
        read(asset_type="Index")


def test_jobs(spark, history):
    out = plans.ingest_history(
        spark, history, {"Stock": ["A"], "Index": ["N"]}, start="2020-02-01", end="2020-12-31", as_of="2024-02-01"
    )
    assert ordinals(out) == [1, 5]


def test_store_prunes_and_is_empty_for_unknown(spark, history):
    etf, none = store.get_data(spark, history, history, "ETF")[0], store.read_store(spark, history, "Bond")
    assert ordinals(etf) == [3] and none.count() == 0 and none.columns == etf.columns
    plan = etf._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(asset_type" in plan


def test_option_chain_without_greeks(spark):
    path = scratch_path(spark, "chain")
    spark.sql(
        "select '05-08-2024' fetch_time, 'A' symbol, 100D strike_price, 'e' expiry_date, 1D calls_ltp, 2D puts_ltp, "
        "3D calls_iv, 4D puts_iv, 5D calls_oi, 6D puts_oi, 7D calls_volume, 8D puts_volume, 0.5D calls_delta"
    ).write.parquet(path)
    out = plans.ingest_options(spark, path, {"Stock": ["A"]}).collect()
    assert [(r.option_type, r.option_close_price, r.volume, r.delta, r.vega) for r in out] == [
        ("call", 1.0, 7.0, 0.5, None), ("put", 2.0, 8.0, None, None),
    ]
    assert out[0].asset_type == "Stock"
    assert plans.ingest_options(spark, path, {"ETF": ["A"]}).count() == 0


def test_unpivot_of_a_frame_without_optional_columns(spark):
    df = spark.sql("select 'd' fetch_time, 'A' symbol, 1D strike_price, 'e' expiry_date, 1D calls_ltp, 2D puts_ltp, "
                   "3D calls_iv, 4D puts_iv, 5D calls_oi, 6D puts_oi, 7D calls_volume, 8D puts_volume")
    assert [r.gamma for r in reshape.unpivot_chain(df).collect()] == [None, None]


def test_a_broken_file_counts_as_empty(spark, tmp_path):
    good = spark.createDataFrame([(1, "u", "h")], "page_id bigint, url string, html string")
    good.coalesce(1).write.parquet(str(tmp_path / "pages"))
    (tmp_path / "pages" / "broken.parquet").write_bytes(b"PAR1 not really")
    assert files.read_pages(spark, str(tmp_path / "pages"), skip_bad_files=True).count() == 1
    with pytest.raises(Exception):
        files.read_pages(spark, str(tmp_path / "pages")).collect()


def test_errors_of_a_tolerant_run(spark, history, tmp_path):
    import pathlib
    import shutil

    folder = tmp_path / "history"
    shutil.copytree(history.removeprefix("file:"), folder)
    (pathlib.Path(folder) / "asset_type=Stock").mkdir(exist_ok=True)
    (folder / "asset_type=Stock" / "broken.parquet").write_bytes(b"PAR1 not really")
    jobs = {"Stock": ["A", "Z"], "Index": ["N"]}
    found = plans.ingest_history(
        spark, str(folder), jobs, start="2020-01-01", end="2020-12-31", as_of="2024-02-01", skip_bad_files=True
    )
    errors = plans.ingest_errors(spark, str(folder), jobs, found).collect()
    assert sorted((r.ticker or "", (r.file or "").split("/")[-1], r.reason) for r in errors) == [
        ("", "broken.parquet", "not readable"), ("Z", "", "no rows")
    ]


def test_empty_source_adds_nothing(spark):
    none = files.empty(spark, schemas.NEWS_ARTICLES)
    assert reshape.union_all(none, none).count() == 0 and none.columns[0] == "ordinal"


def test_union_by_name(spark):
    out = reshape.union_all(spark.sql("select 1 a"), spark.sql("select 2 b"), spark.sql("select 1 a"))
    assert sorted((r.a or 0, r.b or 0) for r in out.collect()) == [(0, 2), (1, 0), (1, 0)]


def test_optional_and_existing(spark):
    df = reshape.with_optional(spark.sql("select 1 a"), {"a": "int", "v": "double"})
    assert df.dtypes == [("a", "int"), ("v", "double")] and reshape.existing(df, ["v", "w"]) == ["v"]


def test_options_join_keeps_lonely_history(spark):
    history = spark.range(5).select(F.col("id").alias("ticker"), F.lit(1.0).alias("price"))
    options = spark.range(400).select(F.when(F.col("id") < 390, 1).otherwise(F.col("id") % 3).cast("bigint").alias("ticker"), F.col("id").alias("strike"))
    parts = {"on": ["ticker"], "option_key": ["strike"]}
    salted = reshape.history_join_options(history, options, rows=50, **parts)
    plain = reshape.history_join_options(history, options, **parts)
    assert salted.columns == plain.columns
    assert salted.exceptAll(plain).isEmpty() and plain.exceptAll(salted).isEmpty()


def test_prompt_text(spark):
    df = spark.sql("select 'i' instruction, 'x' input, cast(null as string) response")
    text = prompts.train_text(df, eos="<E>").first().text
    assert text.endswith("### Instruction:\ni\n\n### Input:\nx\n\n### Response:\nNone<E>")
    generated = ["a ### Response:\n\n bullish\n### Response: b", "no mark", None]
    out = spark.createDataFrame([(g,) for g in generated], "g string").select(prompts.extract_response(F.col("g")).alias("r"))
    assert [r.r for r in out.collect()] == ["bullish", "", None]


def test_shared_folder_is_the_one_the_session_names(spark):
    named = spark.conf.get("spark.checkpoint.dir", None)
    folder = shared_folder(spark)
    assert folder == named if named else folder
    assert scratch_path(spark, "x").startswith(folder)


def test_windows_over_a_window_store_read_it_where_it_lies(spark, tmp_path):
    from marketspark.operators import features

    rows = spark.range(3000).select(
        F.concat(F.lit("T"), (F.col("id") % 40).cast("string")).alias("ticker"), F.expr("date_add(date'2024-01-01', cast(id div 40 as int))").alias("trade_date"),
        F.col("id").cast("double").alias("close_price"), F.when(F.col("id") % 40 < 20, "Stock").otherwise("ETF").alias("asset_type"),
    )
    kept = store.WindowStore(str(tmp_path / "a"), buckets=4).create(rows.where("close_price < 2000"))
    for low in (2000, 2400, 2700):
        kept.append(rows.where(f"close_price >= {low} and close_price < {low + (400 if low == 2000 else 300)}"))
    small = len(list((tmp_path / "a").glob("asset_type=ETF/*.parquet")))
    tidy = kept.compact(spark, str(tmp_path / "b"))
    assert small == 16 and len(list((tmp_path / "b").glob("asset_type=ETF/*.parquet"))) == 4
    plain = features.price_features(rows.where("asset_type = 'ETF'"), key="ticker", order=["trade_date"])
    for one in (kept, tidy):
        found = features.price_features(store.read_store(spark, one, "ETF"), key="ticker", order=["trade_date"], largest=75)
        text = found._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in text and "PartitionFilters: [isnotnull(asset_type" in text
        assert sorted(map(str, found.select(*sorted(plain.columns)).collect())) == sorted(map(str, plain.select(*sorted(plain.columns)).collect()))


def test_another_session_learns_how_a_store_is_laid_out(spark, tmp_path):
    rows = spark.range(100).select(F.concat(F.lit("T"), (F.col("id") % 5).cast("string")).alias("ticker"), F.col("id").alias("trade_date"), F.lit("Stock").alias("asset_type"))
    kept = store.WindowStore(str(tmp_path / "a"), buckets=4).create(rows)
    spark.sql(f"drop table {kept.table}")
    again = kept.frame(spark)
    assert again.count() == 100 and sorted(again.columns) == ["asset_type", "ticker", "trade_date"]
    assert "Exchange" not in again.groupBy("ticker").count()._jdf.queryExecution().executedPlan().toString()


def test_errors_of_pages_are_listed_with_those_of_files(spark, tmp_path):
    history = spark.createDataFrame([("Stock", "A")], "asset_type string, ticker string")
    history.coalesce(1).write.parquet(str(tmp_path / "h"))
    pages = spark.createDataFrame([("A", "u", 2, "no link"), ("B", "v", None, "no body")], "ticker string, url string, part int, error string")
    found = plans.ingest_errors(spark, str(tmp_path / "h"), {"Stock": ["A", "Z"]}, history, pages)
    assert sorted(map(tuple, found.collect()), key=repr) == sorted([
        ("Stock", "Z", None, "no rows"), (None, "A", "u", "part 2: no link"), (None, "B", "v", "no body"),
    ], key=repr)
