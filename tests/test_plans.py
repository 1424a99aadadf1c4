"""Shape of the physical plans: what is shuffled, joined and read."""

import re

import pytest
from pyspark.sql import functions as F

from marketspark import catalog
from marketspark.catalog import market
from conftest import TESTDATA
from marketspark.operators import cleaning, encoding, features, news, ordering, reshape

FOLDER = f"{TESTDATA}/sf0.001"
catalog.load()


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_all_features_share_one_shuffle_and_one_sort(spark):
    rows = features.prompt_features(market.series(spark, FOLDER), **market.KEY)
    text = plan(features.target(rows, **market.KEY))
    assert text.count("Exchange hashpartitioning") == 1 and text.count("Sort [") == 1


def test_long_series_are_pieced_without_a_second_shuffle(spark):
    df = spark.range(6000).select(
        (F.col("id") % 2).alias("ticker"), F.col("id").alias("ordinal"), F.col("id").cast("double").alias("close_price")
    )
    text = plan(features.macd(df, key="ticker", order=["ordinal"]))
    assert "_piece" in text and text.count("Exchange hashpartitioning") == 1


def test_divided_fill_never_gathers_the_rows(spark):
    df = market.hot_series(spark, FOLDER)
    for by in ([], ["ticker"]):
        text = plan(ordering.last_known(df, ["close_price"], order=["event_id"], by=by, block_rows=50))
        for tail in re.split("Exchange SinglePartition", text)[1:]:
            assert "Aggregate" in tail.split("Exchange")[0], "only block summaries may meet in one task"
        assert "SortMergeJoin" not in text


def test_copies_are_dropped_before_the_shuffle(spark):
    docs = catalog.table(spark, FOLDER, "documents")
    text = plan(cleaning.drop_duplicates_first(docs, ["text"], order=["doc_id"]))
    assert re.search(r"Exchange hashpartitioning\(_digest.*WindowGroupLimit.*Partial", text, re.S)


def test_standard_scores_do_not_shuffle_rows(spark):
    rows = catalog.table(spark, FOLDER, "customer")
    text = plan(encoding.standardize(rows, ["c_acctbal"]))
    main = text.split("Subquery")[0]
    assert "Join" not in text and "Exchange" not in main


def test_unpivot_is_narrow_and_reads_only_its_columns(spark):
    text = plan(catalog.QUERIES["chain_unpivot"](spark, FOLDER).select("ticker", "volume"))
    assert "Exchange" not in text
    assert "ReadSchema: struct<l_orderkey:bigint,l_linenumber:int,l_quantity:double>" in text


def test_filter_on_a_tag_leaves_one_scan(spark):
    rows = catalog.table(spark, FOLDER, "orders")
    both = reshape.union_all(reshape.tag(rows, asset_type="Stock"), reshape.tag(rows, asset_type="ETF"))
    text = plan(both.where("asset_type = 'ETF'"))
    assert text.count("FileScan") == 1 and "Union" not in text


@pytest.mark.parametrize("name", ["clean_text", "parse_amount", "normalize_dates", "prompt_train", "split_exact", "extract_response", "label_codes"])
def test_row_functions_are_narrow_and_in_the_jvm(spark, name):
    text = plan(catalog.QUERIES[name](spark, FOLDER))
    assert "Exchange" not in text and "Python" not in text


def test_counts_are_combined_before_the_shuffle(spark):
    for name in ("value_counts", "confusion_cells", "class_report", "overall_sentiment", "binary_metrics"):
        text = plan(catalog.QUERIES[name](spark, FOLDER))
        assert "partial_" in text, name


def test_few_links_leave_the_pages_where_they_are(spark):
    pages = catalog.table(spark, FOLDER, "pages")
    links = pages.select("page_id", F.col("url").alias("link"))
    text = plan(news.join_articles(links, pages, row_key=["page_id"]))
    assert "BroadcastHashJoin" in text and "Exchange hashpartitioning" not in text
    assert "_salt" in plan(news.join_articles(links, pages, row_key=["page_id"], rows=1, small_rows=0))
