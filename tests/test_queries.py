"""Every registered query against its SQL, and the driver contract."""

import pytest

import __spark_entry__ as entry_module
from marketspark import catalog
from compare import connect, spark_rows, sql_rows

from conftest import TESTDATA

FOLDER = f"{TESTDATA}/sf0.01"
QUERIES = entry_module.queries()
SQL = entry_module.oracle_sql()


@pytest.fixture(scope="module")
def duck():
    return connect(FOLDER)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_gives_the_rows_of_its_sql(name, spark, duck):
    names, rows = spark_rows(QUERIES[name](spark, FOLDER))
    sql_names, expected = sql_rows(duck, SQL[name])
    assert names == sql_names
    assert len(rows) == len(expected)
    assert rows == expected


def test_every_query_has_sql():
    assert set(catalog.SQL) == set(catalog.QUERIES)


def test_entry(spark):
    out = entry_module.entry(spark)
    assert out.columns == ["ticker", "ts", "event_id", "prompt", "text"]
    rows = out.collect()
    assert len(rows) == spark.read.parquet(f"{TESTDATA}/sf0.001/events.parquet").count()
    full = [r for r in rows if "30-day SMA: " in r.prompt][0]
    assert full.prompt.startswith("Lag1_ClosePrice: ")
    assert full.text.endswith(full.prompt + "\n\n### Response:\n")
