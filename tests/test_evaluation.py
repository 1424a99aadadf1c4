import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from marketspark.operators import evaluation as E
from marketspark.plans import evaluation as plans


def judged(spark, pairs):
    return spark.createDataFrame(pairs, "y string, p string")


B, S = "bullish", "bearish"


def test_vote_tie(spark):
    row = E.overall_sentiment(judged(spark, [(B, B), (B, S), (S, B), (S, B)]), y="y", p="p").first()
    assert row.actual_sentiment == "neutral" and row.predicted_sentiment == B
    assert (row.actual_bullish, row.predicted_bearish) == (2, 1)


def test_binary_metrics_edges(spark):
    row = E.binary_metrics(judged(spark, [(S, S), (B, S)]), y="y", p="p").first()
    assert (row.accuracy, row.precision, row.recall, row.f1, row.n_unmapped) == (0.5, 0, 0, 0, 0)
    odd = judged(spark, [(B, B), (B, "sideways"), (B, None)])
    row = E.binary_metrics(odd, y="y", p="p").first()
    assert row.n_unmapped == 2 and row.accuracy == pytest.approx(1 / 3)
    with pytest.raises(Exception, match="labels other"):
        E.binary_metrics(odd, y="y", p="p", strict=True).collect()


def test_matrix_has_zero_cells(spark):
    rows = judged(spark, [(B, S), (B, S), (S, "x"), (S, None), ("y", B)])
    cells = {(c.truth, c.predicted): c.n for c in E.confusion_matrix(rows, y="y", p="p", labels=[S, B]).collect()}
    assert len(cells) == 9 and sum(cells.values()) == 5
    assert (cells[B, S], cells[S, "other"], cells["other", B], cells[B, B]) == (2, 2, 1, 0)


def test_matrix_of_endless_answers(spark):
    df = spark.range(2000).select(F.col("id").alias("y"), F.col("id").alias("p"))
    cells = {(c.truth, c.predicted): c.n for c in E.confusion_matrix(df, y="y", p="p", labels=[1, 2]).collect()}
    assert len(cells) == 9 and cells["1", "1"] == 1 and cells["other", "other"] == 1998
    assert E.confusion_cells(df, y="y", p="p").count() == 2000


def test_report_of_a_label_never_predicted(spark):
    report = E.class_report(judged(spark, [(B, B), (B, S), (S, S), (S, S), ("x", S)]), y="y", p="p")
    rows = {r.label: (r.precision, r.recall, r.f1, r.support) for r in report.collect()}
    assert rows["x"] == (0.0, 0.0, 0.0, 1)
    assert rows[S] == pytest.approx((0.5, 1.0, 2 / 3, 2))
    assert rows["accuracy"][0] == 0.6 and rows["macro avg"][3] == 5
    assert rows["weighted avg"][1] == pytest.approx((0.5 * 2 + 1.0 * 2) / 5)


HAND = [(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.4)]


def scored(spark, pairs):
    return spark.createDataFrame([(int(y), float(s)) for y, s in pairs], "y int, score double")


def test_areas_by_hand(spark):
    df = scored(spark, HAND)
    assert E.roc_auc(df, y="y", score="score").first()[0] == pytest.approx(0.75)
    assert E.average_precision(df, y="y", score="score").first()[0] == pytest.approx(0.8055555556)


def brute_curve(pairs):
    """(threshold, fpr, tpr, precision) for each distinct score, from the top."""
    y = np.array([a for a, _ in pairs])
    s = np.array([b for _, b in pairs])
    rows = []
    for t in sorted(set(s), reverse=True):
        called = s >= t
        tp, fp = (y[called] == 1).sum(), (y[called] == 0).sum()
        rows.append((t, fp / (y == 0).sum(), tp / (y == 1).sum(), tp / (tp + fp)))
    return rows


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(
    st.lists(st.tuples(st.integers(0, 1), st.integers(0, 9)), min_size=1, max_size=50),
    st.sampled_from([2, 5, 1000]),
)
def test_curves_match_brute_force(spark, pairs, block_rows):
    pairs = pairs + [(0, 4), (1, 4)]
    df, rows = scored(spark, pairs), brute_curve(pairs)
    same = {"y": "y", "score": "score", "block_rows": block_rows}
    points = sorted((r.threshold, r.fpr, r.tpr) for r in E.roc_points(df, **same).collect() if r.threshold is not None)
    assert np.allclose(points, sorted(r[:3] for r in rows))
    pr = sorted((r.threshold, r.precision, r.recall) for r in E.pr_points(df, **same).collect() if r.threshold is not None)
    assert np.allclose(pr, sorted((t, p, r) for t, _, r, p in rows))
    x = [0, *[r[1] for r in rows]]
    h = [0, *[r[2] for r in rows]]
    assert E.roc_auc(df, **same).first()[0] == pytest.approx(np.trapezoid(h, x))
    steps = sum((b[2] - a) * b[3] for a, b in zip(h, rows))
    assert E.average_precision(df, **same).first()[0] == pytest.approx(steps)
    # the points left by drop_intermediate bound the same area
    kept = [(r.fpr, r.tpr) for r in E.roc_points(df, drop_intermediate=True, **same).collect()]
    kept.sort()
    assert np.trapezoid([b for _, b in kept], [a for a, _ in kept]) == pytest.approx(np.trapezoid(h, x))
    corners = [0, *[i for i in range(1, len(rows) - 1) if turns(pairs, rows, i)], len(rows) - 1]
    assert len(kept) == 1 + len(set(corners))


def turns(pairs, rows, i):
    """Does the curve bend at point i (the counts of the next score differ)?"""
    def own(j):
        here = [y for y, s in pairs if s == rows[j][0]]
        return here.count(1), here.count(0)

    return own(i) != own(i + 1)


def test_rows_without_truth_or_score_are_counted(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.1), (None, 0.5), (1, None), (None, None)], "y int, score double")
    assert tuple(E.roc_auc(df, y="y", score="score").first()) == (1.0, 3)
    assert tuple(E.average_precision(df, y="y", score="score").first()) == (1.0, 3)
    with pytest.raises(ValueError, match="3 rows"):
        E.roc_points(df, y="y", score="score", strict=True)
    assert [r.threshold for r in E.roc_points(df, y="y", score="score").collect()] == [None, 0.9, 0.1]
    assert [r.threshold for r in E.pr_points(df, y="y", score="score").collect()] == [0.1, 0.9, None]


def test_nulls_count_in_the_class_report(spark):
    df = spark.createDataFrame([("a", "a"), ("a", None), (None, "b"), ("b", "b")], "y string, p string")
    rows = E.class_report(df, y="y", p="p").collect()
    assert [r.label for r in rows] == ["None", "a", "b", "accuracy", "macro avg", "weighted avg"]
    assert rows[3].precision == 0.5 and rows[3].support == 4


def test_one_class_only_has_no_area(spark):
    df = scored(spark, [(1, 0.5), (1, 0.7)])
    assert E.roc_auc(df, y="y", score="score").first()[0] is None


def counting(calls):
    @F.udf("string")
    def same(text):
        calls.add(1)
        return text

    return same


def test_whole_evaluation(spark):
    rows = [(i, "up" if i % 4 else "down", B if i % 4 else S) for i in range(40)]
    test = spark.createDataFrame(rows, "id bigint, prompt string, target string")

    def make_model():
        import numpy as np

        return lambda texts: np.array([t + ("\n bullish\n" if "\nup\n" in t else "sideways") for t in texts], dtype=object)

    result = plans.score(test, make_predict_fn=make_model)
    assert result.columns == ["id", "prompt", "target", "prediction"]
    calls = spark.sparkContext.accumulator(0)
    counted = result.withColumn("prediction", counting(calls)(F.col("prediction")))
    tables = {name: df.collect() for name, df in plans.report(counted).items()}
    assert calls.value == 40, "the model runs once per row for all tables"
    assert tables["metrics"][0].n_unmapped == 10 and tables["metrics"][0].recall == 1.0
    assert tables["predicted_counts"][0].asDict() == {"prediction": B, "n": 30}
    assert tables["overall_sentiment"][0].predicted_sentiment == B
    assert len(tables["confusion_matrix"]) == 9
    assert sum(r.n for r in tables["confusion_matrix"]) == 40
    assert tables["roc_auc"][0].n_unmapped == 10


def test_value_counts_order(spark):
    df = spark.createDataFrame([("b",), ("a",), ("b",), (None,), ("c",), ("c",)], "v string")
    assert [tuple(r) for r in E.value_counts(df, "v").collect()] == [("b", 2), ("c", 2), ("a", 1)]
    assert tuple(E.row_counts(spark.range(33)).first()) == (33, 3)
