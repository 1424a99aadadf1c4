"""Training sets, scoring and the evaluation of predictions."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marketspark.operators import evaluation, prompts, sampling, scoring
from marketspark.operators.skew import written


def training_set(
    rows: DataFrame, *, eos: str, key: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """(balanced train rows, test rows): text built, rows split, only the train side balanced."""
    marked = sampling.split_exact(
        prompts.train_text(rows, eos=eos), key=key, test_size=test_size, seed=seed
    )
    train = marked.where(F.col("split") == "train").drop("split")
    test = marked.where(F.col("split") == "test").drop("split")
    balanced = sampling.oversample(
        train, label="response", key=key, seed=seed, columns=["text", "response"]
    )
    return balanced, test


def score(test: DataFrame, *, make_predict_fn: Callable, prompt: str = "prompt") -> DataFrame:
    """Add ``prediction``: the answer part of what the model makes of each prompt.

    Lazy: write the result when more than one job reads it, or the model runs for each.
    """
    asked = test.withColumn("_text", prompts.eval_text(prompt))
    generated = scoring.batch_predict(
        asked, make_predict_fn=make_predict_fn, input_col="_text", output_col="_generated"
    )
    return scoring.answer(generated, generated="_generated").drop("_text", "_generated")


def report(scored: DataFrame, *, y: str = "target", p: str = "prediction") -> dict[str, DataFrame]:
    """Every table of the evaluation; curves use the label codes of the predictions.

    Answers other than the two labels are counted: ``n_unmapped`` of the metrics and areas, ``other``
    in the matrix.
    Truth and prediction are written first, so that the model runs once for all tables.
    """
    judged = written(scored.select(y, p))
    coded = judged.select(
        evaluation.label_code(F.col(y)).alias("y"), evaluation.label_code(F.col(p)).alias("score")
    )
    curve = evaluation.ScoreCurve(coded, y="y", score="score")
    return {
        "predicted_counts": evaluation.value_counts(judged, p),
        "target_counts": evaluation.value_counts(judged, y),
        "metrics": evaluation.binary_metrics(judged, y=y, p=p),
        "class_report": evaluation.class_report(judged, y=y, p=p),
        "confusion_matrix": evaluation.confusion_matrix(
            judged, y=y, p=p, labels=[evaluation.NEGATIVE, evaluation.POSITIVE]
        ),
        "roc_points": curve.roc_points(drop_intermediate=True),
        "roc_auc": curve.roc_auc(),
        "pr_points": curve.pr_points(),
        "average_precision": curve.average_precision(),
        "overall_sentiment": evaluation.overall_sentiment(judged, y=y, p=p),
    }
