import pytest
from pyspark.sql import functions as F

from marketspark.operators import skew


@pytest.fixture(scope="module")
def sides(spark):
    left = spark.range(3000).select(
        "id", F.when(F.col("id") < 1000, None).when(F.col("id") < 2000, 5).otherwise(F.col("id") % 40).cast("int").alias("k")
    )
    right = spark.range(30).select(F.col("id").cast("int").alias("k"), (F.col("id") * 10).alias("v"))
    return left, right


@pytest.mark.parametrize("how", ["inner", "left"])
@pytest.mark.parametrize("rows", [50, 1_000_000])
def test_salted_join_is_a_join(sides, how, rows):
    left, right = sides
    out = skew.salted_join(left, right, ["k"], how, row_key=["id"], rows=rows)
    assert sorted(out.columns) == ["id", "k", "v"]
    expected = left.join(right, "k", how).select(*out.columns)
    assert out.exceptAll(expected).isEmpty() and expected.exceptAll(out).isEmpty()


def test_hot_keys_and_salts(sides):
    left, _ = sides
    hot = {r["k"]: r[skew.COPIES] for r in skew.hot_keys(left, ["k"], rows=100).collect()}
    assert hot == {None: 11, 5: 11}
    assert skew.hot_keys(left, ["k"], rows=5000) is None


def test_copies_of_one_row_are_seen_as_hot(spark):
    copies = spark.range(40_000).select(F.lit(1).alias("k"), F.lit("same").alias("v"))
    assert [r.k for r in skew.hot_keys(copies, ["k"], rows=20_000).collect()] == [1]


def test_broadcast_only_up_to_the_checked_size(spark):
    rows = spark.range(1000)
    for size, kind in ((10, True), (11, False)):
        side = skew.small_side(spark.range(size), 10)
        logical = rows.join(side, "id")._jdf.queryExecution().logical().toString()
        assert ("UnresolvedHint broadcast" in logical or "ResolvedHint" in logical) == kind


def test_hot_keys_of_rows_that_come_in_turns(spark):
    turns = spark.range(80_000).select(F.when(F.col("id") % 4 == 1, -1).otherwise(F.col("id")).alias("k"))
    assert [r.k for r in skew.hot_keys(turns, ["k"], rows=10_000).collect()] == [-1]


@pytest.mark.parametrize("rows", [50, 1_000_000])
def test_dealt_partitions_are_kept(sides, rows):
    left, right = sides
    out = skew.salted_join(left, right, ["k"], "left", row_key=["id"], rows=rows, partitions=13)
    assert out.rdd.getNumPartitions() == 13
    expected = left.join(right, "k", "left").select(*out.columns)
    assert out.exceptAll(expected).isEmpty() and expected.exceptAll(out).isEmpty()
