"""Divided groups must give what one window gives, wherever the cuts fall."""

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from marketspark.operators import ordering as O

rows_of = st.lists(
    st.tuples(
        st.sampled_from(["a", "b", None]), st.integers(0, 6) | st.just(3) | st.none(), st.none() | st.integers(-5, 5)
    ),
    min_size=1, max_size=60,
)


def frame(spark, rows, parts=4):
    pdf = pd.DataFrame(
        {"k": [r[0] for r in rows], "t": [r[1] for r in rows], "id": range(len(rows)), "v": [r[2] for r in rows]}
    )
    whole = lambda x: None if pd.isna(x) else int(x)
    data = [(k, whole(t), int(i), whole(v)) for k, t, i, v in pdf.itertuples(index=False)]
    return spark.createDataFrame(data, "k string, t bigint, id bigint, v bigint").repartition(parts, "id")


def by_id(df):
    return {r["id"]: tuple(r[c] for c in sorted(df.columns)) for r in df.collect()}


def brute(rows, by):
    """position and last known value per id."""
    groups, out = {}, {}
    order = sorted(range(len(rows)), key=lambda i: (rows[i][1] is not None, rows[i][1] or 0, i))
    for i in order:
        key = rows[i][0] if by else "all"
        n, known = groups.get(key, (0, None))
        known = rows[i][2] if rows[i][2] is not None else known
        out[i] = (n, known)
        groups[key] = (n + 1, known)
    return out


@settings(max_examples=12, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_of, block_rows=st.sampled_from([1, 3, 7, 1000]), keyed=st.booleans())
def test_positions_and_fills_match_brute_force(spark, rows, block_rows, keyed):
    by = ["k"] if keyed else []
    df = frame(spark, rows)
    placed = O.with_positions(df, order=["t", "id"], by=by, block_rows=block_rows)
    filled = O.last_known(df, ["v"], order=["t", "id"], by=by, block_rows=block_rows)
    expected = brute(rows, keyed)
    assert {r["id"]: r[O.POSITION] for r in placed.collect()} == {i: p for i, (p, _) in expected.items()}
    assert {r["id"]: r["v"] for r in filled.collect()} == {i: v for i, (_, v) in expected.items()}
    assert sorted(filled.columns) == sorted(df.columns)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(rows=rows_of, piece=st.sampled_from([4, 5, 9, 1000]))
def test_moving_windows_match_one_window(spark, rows, piece):
    df = frame(spark, rows)

    def compute(part, w):
        return part.select(
            "*", F.lag("id", 3).over(w).alias("before"), F.lead("id", 2).over(w).alias("after"),
            F.sum("v").over(w.rowsBetween(-3, 2)).alias("total"),
        )

    same = {"order": ["t", "id"], "by": ["k"], "before": 3, "after": 2}
    assert by_id(O.moving(df, compute, rows=piece, block_rows=5, **same)) == by_id(O.moving(df, compute, **same))


def test_a_value_shared_by_a_third_of_the_rows_is_divided_too(spark):
    df = spark.range(3000).select(
        F.lit("hot").alias("k"), F.when(F.col("id") < 1000, 7).otherwise(F.col("id") % 20).cast("bigint").alias("t"),
        "id",
    )
    blocked, _ = O.with_blocks(df, order=["t", "id"], by=["k"], largest=3000, block_rows=100)
    assert O.largest_group(blocked, ["k", O.BLOCK]) <= 400
    placed = O.with_positions(df, order=["t", "id"], by=["k"], block_rows=100)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")) - 1)
    assert placed.join(plain, "id").where(F.col("p") != F.col(O.POSITION)).count() == 0


@pytest.mark.parametrize("by", [[], ["k"]])
@pytest.mark.parametrize("nulls", [1000, 3000])
def test_rows_without_a_first_value_are_divided_too(spark, by, nulls):
    df = spark.range(3000).select(
        F.lit(1).alias("k"), F.when(F.col("id") >= nulls, F.col("id") % 20).alias("t"),
        F.when(F.col("id") > 0, F.col("id")).alias("id"),
    )
    order = ["t", "id"]
    blocked, bound = O.with_blocks(df, order=order, by=by, largest=3000, block_rows=100)
    assert sorted(blocked.columns) == sorted([*df.columns, O.BLOCK, O.CUT])
    assert O.largest_group(blocked, [*by, O.BLOCK]) <= 400
    assert blocked.select(O.BLOCK).distinct().count() <= bound
    placed = O.with_positions(df, order=order, by=by, block_rows=100)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    both = placed.join(plain, placed["id"].eqNullSafe(plain["id"]))
    assert both.count() == 3000 and both.where(F.col("p") != F.col(O.POSITION)).count() == 0


@pytest.mark.parametrize("by", [[], ["k"]])
def test_values_shared_in_two_columns_are_divided_along_the_third(spark, by):
    mostly = F.when(F.col("id") < 2000, 7)
    df = spark.range(3000).select(
        F.lit(None).cast("string").alias("k"), mostly.otherwise(F.col("id") % 20).alias("t"),
        mostly.otherwise(F.col("id") % 30).alias("u"), "id",
    )
    order = ["t", "u", "id"]
    blocked, bound = O.with_blocks(df, order=order, by=by, largest=3000, block_rows=100)
    assert O.largest_group(blocked, [*by, O.BLOCK]) <= 400
    assert blocked.select(O.BLOCK).distinct().count() <= bound
    placed = O.with_positions(df, order=order, by=by, block_rows=100)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy(*by).orderBy(*order)) - 1)
    assert placed.join(plain, "id").where(F.col("p") != F.col(O.POSITION)).count() == 0


@pytest.mark.parametrize("kind", ["date", "timestamp", "timestamp_ntz", "double", "decimal(20,3)"])
def test_order_columns_of_every_kind(spark, kind):
    day = F.expr("date'2024-01-01'")
    t = F.date_add(day, F.col("id").cast("int")) if kind == "date" else F.col("id").cast("double")
    if kind.startswith("timestamp"):
        t = F.timestamp_seconds(F.col("id") * 1800.5)
    df = spark.range(500).select((F.lit(499) - F.col("id")).alias("id"), t.cast(kind).alias("t"))
    placed = O.with_positions(df, order=["t"], block_rows=30)
    assert placed.where(F.col(O.POSITION) != 499 - F.col("id")).count() == 0


@pytest.mark.parametrize("order", [["t"], ["t", "id"]])
def test_a_null_in_the_order_comes_first(spark, order):
    df = spark.range(60).select("id", F.when(F.col("id") > 0, F.col("id")).alias("t"), F.when(F.col("id") < 1, 9).alias("v"))
    filled = O.last_known(df, ["v"], order=order, block_rows=10)
    assert {r.v for r in filled.collect()} == {9}


TEXTS = ["", "a", "a\x00", "a\x00\x00b", "abcdefg", "abcdefg\x00", "abcdefgh", "abcdefghijklmnopq", "abcdefghijklmnopqr", "é", "日本語", "zz"]


@pytest.mark.parametrize("kind", ["string", "binary", "boolean"])
@pytest.mark.parametrize("block_rows", [3, 10, 100_000])
def test_text_and_booleans_place_cuts(spark, kind, block_rows):
    """Many equal texts, texts that begin alike, and zero bytes at the end; the size changes nothing."""
    rows = [(i, TEXTS[i * 7 % len(TEXTS)] if i % 3 else "abcdefghijklmnopq" + "x" * (i % 5)) for i in range(300)]
    df = spark.createDataFrame([*rows, (300, None)], "id bigint, t string")
    df = df.withColumn("t", F.length("t") % 2 == 0 if kind == "boolean" else F.col("t").cast(kind))
    placed = O.with_positions(df, order=["t", "id"], block_rows=block_rows)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy().orderBy("t", "id")) - 1)
    both = placed.join(plain.select("id", "p"), "id")
    assert both.count() == 301 and both.where(F.col("p") != F.col(O.POSITION)).count() == 0


def test_one_text_column_alone_places_cuts(spark):
    df = spark.range(500).select(F.format_string("https://example.org/pages/%05d", "id").alias("t"), "id")
    placed = O.with_positions(df, order=["t"], block_rows=20)
    assert placed.where(F.col(O.POSITION) != F.col("id")).count() == 0
    blocked, _ = O.with_blocks(df, order=["t"], largest=500, block_rows=20)
    assert O.largest_group(blocked, [O.BLOCK]) <= 100


def test_columns_without_an_order_are_refused(spark):
    df = spark.range(50).select(F.create_map(F.lit("a"), "id").alias("t"))
    with pytest.raises(Exception):
        O.with_positions(df, order=["t"], block_rows=10).collect()


@pytest.mark.parametrize("parts", [1, 4, 17])
def test_result_does_not_depend_on_the_partitions(spark, parts):
    df = spark.range(400).select("id", (F.col("id") * 37 % 101).alias("t"), (F.col("id") % 3).alias("k"))
    placed = O.with_positions(df.repartition(parts), order=["t", "id"], by=["k"], block_rows=20)
    rows = sorted((r["id"], r[O.POSITION]) for r in placed.collect())
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("t", "id")) - 1)
    assert rows == sorted((r["id"], r["p"]) for r in plain.collect())


@pytest.mark.parametrize("beginning", [0, 7, 5000])
def test_long_shared_beginnings_are_divided_in_one_step(spark, beginning):
    """Texts that differ only behind very many equal signs, with ties and nulls."""
    text = F.concat(F.lit("x" * beginning), F.format_string("%05d", F.col("id") % 900))
    df = spark.range(2000).select("id", F.when(F.col("id") % 50 > 0, text).alias("t"))
    blocked, blocks = O.with_blocks(df, order=["t", "id"], largest=2000, block_rows=100)
    assert blocked.schema[O.BLOCK].dataType.simpleString() == "bigint"
    assert O.largest_group(blocked, [O.BLOCK]) <= 400 and blocks >= 20
    placed = O.with_positions(df, order=["t", "id"], block_rows=100)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy().orderBy("t", "id")) - 1)
    assert placed.join(plain, "id").where(F.col("p") != F.col(O.POSITION)).count() == 0


def test_cuts_too_long_together_are_thinned(spark, monkeypatch):
    df = spark.range(1000).select("id", F.concat(F.lit("y" * 300), F.col("id").cast("string")).alias("t"), (F.col("id") % 2).alias("k"))
    monkeypatch.setattr(O, "CUT_BYTES", 2000)
    blocked, blocks = O.with_blocks(df, order=["t"], by=["k"], largest=500, block_rows=10)
    assert 2 <= blocked.select(O.BLOCK).distinct().count() <= 12
    placed = O.with_positions(df, order=["t"], by=["k"], block_rows=10)
    plain = df.withColumn("p", F.row_number().over(Window.partitionBy("k").orderBy("t")) - 1)
    assert placed.join(plain, "id").where(F.col("p") != F.col(O.POSITION)).count() == 0


def test_the_cuts_are_one_constant_in_the_plan(spark):
    df = spark.range(1000).select("id", F.col("id").cast("string").alias("t"))
    blocked, _ = O.with_blocks(df, order=["t", "id"], largest=1000, block_rows=100)
    text = blocked._jdf.queryExecution().optimizedPlan().toString()
    assert "from_json" not in text.lower() and "sort_array" not in text and "Join" not in text
