import math

import pytest
from pyspark.sql import functions as F

from marketspark.operators import sampling


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_exact_split(spark, parts):
    df = spark.range(7).repartition(parts)
    out = sampling.split_exact(df, key=["id"], test_size=0.2)
    test = sorted(r.id for r in out.where("split = 'test'").collect())
    assert len(test) == 2 and out.count() == 7
    one = sampling.split_exact(spark.range(7), key=["id"]).where("split = 'test'").collect()
    assert test == sorted(r.id for r in one)


@pytest.mark.parametrize("n,share", [(0, 0.2), (1, 0.2), (1000, 0.333), (5000, 0.0), (5000, 1.0)])
def test_exact_split_sizes(spark, n, share, monkeypatch):
    monkeypatch.setattr(sampling, "FEW", 3)
    monkeypatch.setattr(sampling, "PREFIX", 1)
    out = sampling.split_exact(spark.range(n), key=["id"], test_size=share)
    assert out.where("split = 'test'").count() == math.ceil(share * n)


def test_a_key_that_is_not_unique_is_refused(spark, monkeypatch):
    monkeypatch.setattr(sampling, "FEW", 3)
    with pytest.raises(ValueError, match="unique"):
        sampling.split_exact(spark.range(100).select(F.lit(1).alias("k")), key=["k"])


@pytest.mark.parametrize("few", [1, 50_000])
def test_a_tie_at_the_limit_is_refused_at_any_size(spark, few, monkeypatch):
    monkeypatch.setattr(sampling, "FEW", few)
    twice = spark.range(100).select(F.floor(F.col("id") / 2).alias("k"))
    with pytest.raises(ValueError, match="unique"):
        sampling.take_sample(twice, 49, key=["k"])
    assert sampling.take_sample(twice, 50, key=["k"]).count() == 50


def test_parts_of_a_key_do_not_run_together(spark):
    rows = [(a, b) for a in (None, "", "1", "1-2", "-", "1|1:2") for b in (None, "", "1", "2-3", "3", "-")]
    df = spark.createDataFrame(rows, "a string, b string")
    tokens = df.select(sampling.row_token(["a", "b"], 42).alias("t"))
    assert tokens.distinct().count() == len(rows)
    assert sampling.split_exact(df, key=["a", "b"]).where("split = 'test'").count() == math.ceil(0.2 * len(rows))


@pytest.mark.parametrize("draw_rows", [1, 2, 1000])
@pytest.mark.parametrize("parts", [1, 5])
def test_oversample(spark, draw_rows, parts):
    rows = [(i, "a" if i < 50 else "b" if i < 57 else "c") for i in range(58)]
    df = spark.createDataFrame(rows, "id bigint, response string").repartition(parts)
    out = sampling.oversample(df, label="response", key=["id"], draw_rows=draw_rows)
    counts = {r.response: r.n for r in out.groupBy("response").agg(F.count("*").alias("n")).collect()}
    assert counts == {"a": 50, "b": 50, "c": 50}
    assert out.distinct().count() == 58 and df.exceptAll(out).isEmpty()
    again = sampling.oversample(df.repartition(3), label="response", key=["id"])
    assert out.exceptAll(again).isEmpty()


def test_oversample_leaves_balanced_rows_alone(spark):
    df = spark.createDataFrame([(1, "a"), (2, "b"), (3, None)], "id bigint, response string")
    assert sampling.oversample(df, label="response", key=["id"]).count() == 3


def test_draws_reach_every_row(spark):
    df = spark.range(4000).select("id", F.when(F.col("id") < 20, "b").otherwise("a").alias("y"))
    out = sampling.oversample(df, label="y", key=["id"])
    copies = [r.n for r in out.where("y = 'b'").groupBy("id").agg(F.count("*").alias("n")).collect()]
    assert len(copies) == 20 and sum(copies) == 3980 and max(copies) < 2 * min(copies)


def test_hash_split_and_sample(spark):
    df = spark.range(5000)
    test = sampling.split_hash(df, key=["id"], test_size=0.2).where("split = 'test'").count()
    assert 900 < test < 1100
    sample = sampling.take_sample(df, 100, key=["id"])
    assert sample.distinct().count() == 100
    assert sampling.head(df, order=["id"]).first().id == 0


@pytest.mark.parametrize("n", [0, 100, 4000])
def test_large_samples_are_the_same_rows(spark, n, monkeypatch):
    df = spark.range(3000)
    small = sorted(r.id for r in sampling.take_sample(df, n, key=["id"]).collect())
    monkeypatch.setattr(sampling, "FEW", 5)
    large = sorted(r.id for r in sampling.take_sample(df, n, key=["id"]).collect())
    assert small == large and len(small) == min(n, 3000)
