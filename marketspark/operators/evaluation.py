"""Counts, classification metrics and curves over truth, prediction and score columns.

Everything starts from counts by (truth, prediction) or by score, so the raw rows are read once
and combined before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from marketspark.operators.ordering import BLOCK_ROWS, POSITION, moving, running_total
from marketspark.operators.skew import written

# The two labels and their codes, and the answer for a tie.
POSITIVE, NEGATIVE, TIE = "bullish", "bearish", "neutral"
LABEL_CODES = {"bearish": 0, "bullish": 1}

#: Stands for every label that is not named.
OTHER = "other"


def value_counts(df: DataFrame, column: str, *, name: str = "n") -> DataFrame:
    """Rows per non-null value, most frequent first."""
    counts = df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias(name))
    return counts.orderBy(F.desc(name), column)


def row_counts(df: DataFrame, *, batch_size: int = 16) -> DataFrame:
    """Rows and the batches of ``batch_size`` they fill."""
    return df.agg(F.count(F.lit(1)).alias("n_rows")).withColumn(
        "n_batches", F.ceil(F.col("n_rows") / batch_size).cast("bigint")
    )


def label_code(column: Column, codes: dict[str, int] = LABEL_CODES) -> Column:
    """Code of a label, null for any other value."""
    result = F.lit(None).cast("int")
    for label, code in codes.items():
        result = F.when(column == label, F.lit(code)).otherwise(result)
    return result


def confusion_cells(df: DataFrame, *, y: str, p: str) -> DataFrame:
    """Rows per (truth, prediction) pair that occurs."""
    return df.groupBy(F.col(y).alias("truth"), F.col(p).alias("predicted")).agg(
        F.count(F.lit(1)).alias("n")
    )


def confusion_matrix(df: DataFrame, *, y: str, p: str, labels: Sequence, other: str = OTHER) -> DataFrame:
    """Every (truth, predicted) cell of the named labels and ``other``, zero cells too, as text.

    Any other value of either side, null too, is counted under ``other``, so the cells add up to
    all rows and a model that answers freely makes the table no larger. ``confusion_cells`` has
    the values as they are.
    """
    axis = [*[str(label) for label in labels], other]

    def named(column: str) -> Column:
        text = F.col(column).cast("string")
        return F.when(text.isin(axis[:-1]), text).otherwise(F.lit(other))

    counts = df.select(named(y).alias("truth"), named(p).alias("predicted")).groupBy("truth", "predicted")
    cells = counts.agg(F.count(F.lit(1)).alias("n"))
    one = df.sparkSession.range(0, 1, 1, 1).select(F.explode(F.lit(axis)).alias("truth"))
    matrix = one.select("truth", F.explode(F.lit(axis)).alias("predicted"))
    counted = matrix.join(cells, ["truth", "predicted"], "left")
    return counted.select("truth", "predicted", F.coalesce("n", F.lit(0)).alias("n"))


def _ratio(top: Column, bottom: Column) -> Column:
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))


def _f1(precision: Column, recall: Column) -> Column:
    return _ratio(2 * precision * recall, precision + recall)


def binary_metrics(
    df: DataFrame, *, y: str, p: str, positive=POSITIVE, negative=NEGATIVE, strict: bool = False
) -> DataFrame:
    """One row: accuracy, precision, recall and F1 of ``positive``, 0 where undefined.

    ``n_unmapped`` counts rows in which either side is neither label; ``strict`` raises if any.
    """
    truth, predicted = F.col(y), F.col(p)
    known = truth.isin(positive, negative) & predicted.isin(positive, negative)
    counts = df.agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(truth == predicted).alias("hits"),
        F.count_if((truth == positive) & (predicted == positive)).alias("tp"),
        F.count_if(predicted == positive).alias("called"),
        F.count_if(truth == positive).alias("actual"),
        F.count_if(~F.coalesce(known, F.lit(False))).alias("n_unmapped"),
    )
    unmapped = F.col("n_unmapped")
    if strict:
        unmapped = F.when(unmapped == 0, unmapped).otherwise(
            F.raise_error(F.lit("labels other than the two given")).cast("bigint")
        )
    scored = counts.select(
        _ratio(F.col("hits"), F.col("n")).alias("accuracy"),
        _ratio(F.col("tp"), F.col("called")).alias("precision"),
        _ratio(F.col("tp"), F.col("actual")).alias("recall"),
        unmapped.alias("n_unmapped"),
    )
    return scored.select(
        "accuracy", "precision", "recall",
        _f1(F.col("precision"), F.col("recall")).alias("f1"), "n_unmapped",
    )


def class_report(df: DataFrame, *, y: str, p: str) -> DataFrame:
    """Precision, recall, F1 and support per label in order, then accuracy, macro and weighted rows.

    A null counts as the label ``None``, so that the accuracy is over all rows.
    """
    texts = {c: F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in {y, p}}
    cells = confusion_cells(df.select(*[t.alias(c) for c, t in texts.items()]), y=y, p=p)
    sides = F.array(
        F.struct(F.col("truth").cast("string").alias("label"), F.col("n").alias("support"), F.lit(0).alias("called")),
        F.struct(F.col("predicted").cast("string").alias("label"), F.lit(0).alias("support"), F.col("n").alias("called")),
    )
    hit = F.when((F.col("truth") == F.col("predicted")), F.col("n")).otherwise(F.lit(0))
    sided = cells.select(F.posexplode(sides).alias("side", "s"), hit.alias("hit")).select(
        "s.*", F.when(F.col("side") == 0, F.col("hit")).otherwise(F.lit(0)).alias("tp")
    )
    labels = sided.groupBy("label").agg(
        F.sum("support").alias("support"), F.sum("called").alias("called"), F.sum("tp").alias("tp")
    )
    labels = labels.select(
        "label", "support", "tp",
        _ratio(F.col("tp"), F.col("called")).alias("precision"),
        _ratio(F.col("tp"), F.col("support")).alias("recall"),
    ).withColumn("f1", _f1(F.col("precision"), F.col("recall")))
    metrics = ("precision", "recall", "f1")
    weight = F.sum("support")
    totals = labels.agg(
        weight.alias("support"),
        *[F.avg(m).alias(f"macro_{m}") for m in metrics],
        *[_ratio(F.sum(F.col(m) * F.col("support")), weight).alias(f"weighted_{m}") for m in metrics],
        _ratio(F.sum("tp"), weight).alias("accuracy"),
    )

    def line(place: int, label: str, values: Sequence[Column]) -> Column:
        named = [v.alias(m) for m, v in zip(metrics, values)]
        return F.struct(F.lit(place).alias("_place"), F.lit(label).alias("label"), *named, F.col("support"))

    summary = totals.select(F.inline(F.array(
        line(1, "accuracy", [F.col("accuracy")] * 3),
        line(2, "macro avg", [F.col(f"macro_{m}") for m in metrics]),
        line(3, "weighted avg", [F.col(f"weighted_{m}") for m in metrics]),
    )))
    lines = labels.select(F.lit(0).alias("_place"), "label", *metrics, "support").unionByName(summary)
    return lines.orderBy("_place", "label").drop("_place")


class ScoreCurve:
    """Positives and negatives per distinct score: counted and written once, read by every curve.

    Rows without a truth or a score have no place on a curve; ``n_unmapped`` is their number, and
    ``strict`` raises if there are any.
    """

    def __init__(
        self, df: DataFrame, *, y: str, score: str, positive=1, block_rows: int = BLOCK_ROWS, strict: bool = False
    ):
        hit = F.col(y) == positive
        mapped = F.col(y).isNotNull()
        counts = df.groupBy(F.col(score).alias("threshold")).agg(
            F.count_if(hit).alias("pos"), F.count_if(mapped & ~hit).alias("neg"), F.count_if(~mapped).alias("_lost")
        )
        every = written(counts.withColumn("_rank", -F.col("threshold")))
        scored = F.col("threshold").isNotNull()
        self.counts = every.where(scored & (F.col("pos") + F.col("neg") > 0)).drop("_lost")
        self.n_unmapped = every.agg(F.coalesce(F.sum(
            F.col("_lost") + F.when(scored, F.lit(0)).otherwise(F.col("pos") + F.col("neg"))
        ), F.lit(0))).first()[0]
        if strict and self.n_unmapped:
            raise ValueError(f"{self.n_unmapped} rows without a truth or a score")
        self.scores, self.positives, self.negatives = self.counts.agg(
            F.count(F.lit(1)), F.coalesce(F.sum("pos"), F.lit(0)), F.coalesce(F.sum("neg"), F.lit(0))
        ).first()
        self.block_rows = block_rows

    def _area(self, value: Column, name: str) -> DataFrame:
        return self.running().agg(value.alias(name)).withColumn("n_unmapped", F.lit(self.n_unmapped).cast("bigint"))

    def running(self, corners_only: bool = False) -> DataFrame:
        """True and false positives (``tps``, ``fps``) from the top score down to each score."""
        same = {"order": ["_rank"], "largest": self.scores, "block_rows": self.block_rows}
        totals = {"tps": F.col("pos"), "fps": F.col("neg")}
        if not corners_only:
            return running_total(self.counts, totals, **same).drop("_rank")

        def corners(part: DataFrame, w: WindowSpec) -> DataFrame:
            turns = (F.lead("pos").over(w) != F.col("pos")) | (F.lead("neg").over(w) != F.col("neg"))
            first = F.lag("pos").over(w).isNull()
            return part.withColumn("_corner", first | F.coalesce(turns, F.lit(True)))

        one = F.lit(1).cast("bigint")
        running = running_total(self.counts, {**totals, POSITION: one}, **same)
        running = running.withColumn(POSITION, F.col(POSITION) - 1)
        rows = max(2, self.block_rows)
        marked = moving(running, corners, before=1, after=1, rows=rows, **same)
        return marked.where("_corner").drop("_corner", "_rank", POSITION)

    def _with_end(self, points: DataFrame, **values: float) -> DataFrame:
        """The points and the one that belongs to no score."""
        threshold = F.lit(None).cast(self.counts.schema["threshold"].dataType).alias("threshold")
        end = points.sparkSession.range(0, 1, 1, 1).select(
            threshold, *[F.lit(v).alias(name) for name, v in values.items()]
        )
        return points.unionByName(end)

    def roc_points(self, drop_intermediate: bool = False) -> DataFrame:
        points = self.running(drop_intermediate).select(
            "threshold",
            _ratio(F.col("fps"), F.lit(self.negatives)).alias("fpr"),
            _ratio(F.col("tps"), F.lit(self.positives)).alias("tpr"),
        )
        return self._with_end(points, fpr=0.0, tpr=0.0).orderBy(F.desc_nulls_first("threshold"))

    def roc_auc(self) -> DataFrame:
        area = F.col("neg") * (2 * F.col("tps") - F.col("pos")).cast("double") / 2
        whole = F.lit(float(self.positives) * float(self.negatives))
        return self._area(F.try_divide(F.sum(area), whole), "roc_auc")

    def pr_points(self) -> DataFrame:
        points = self.running().select(
            "threshold",
            _ratio(F.col("tps"), F.col("tps") + F.col("fps")).alias("precision"),
            _ratio(F.col("tps"), F.lit(self.positives)).alias("recall"),
        )
        return self._with_end(points, precision=1.0, recall=0.0).orderBy(F.asc_nulls_last("threshold"))

    def average_precision(self) -> DataFrame:
        step = F.col("pos") * F.col("tps").cast("double") / (F.col("tps") + F.col("fps"))
        whole = F.lit(float(self.positives))
        return self._area(F.try_divide(F.sum(step), whole), "average_precision")


def roc_points(df: DataFrame, *, drop_intermediate: bool = False, **columns) -> DataFrame:
    """(threshold, fpr, tpr) from the start (null, 0, 0) down the distinct scores.

    ``columns`` are those of ``ScoreCurve``: y, score, positive, strict. ``drop_intermediate`` leaves out
    the points on a straight line between their neighbours.
    """
    return ScoreCurve(df, **columns).roc_points(drop_intermediate)


def roc_auc(df: DataFrame, **columns) -> DataFrame:
    """Area under the ROC points, equal scores counting one half, and ``n_unmapped``."""
    return ScoreCurve(df, **columns).roc_auc()


def pr_points(df: DataFrame, **columns) -> DataFrame:
    """(threshold, precision, recall) up the distinct scores to the end (null, 1, 0)."""
    return ScoreCurve(df, **columns).pr_points()


def average_precision(df: DataFrame, **columns) -> DataFrame:
    """Sum of recall steps times precision, without interpolation, and ``n_unmapped``."""
    return ScoreCurve(df, **columns).average_precision()


def _vote(up: Column, down: Column, positive: str, negative: str) -> Column:
    return F.when(up > down, positive).when(down > up, negative).otherwise(TIE)


def overall_sentiment(
    df: DataFrame, *, y: str, p: str, positive=POSITIVE, negative=NEGATIVE
) -> DataFrame:
    """Label counts of truth and prediction in one pass, and the label with more votes."""
    counts = df.agg(*[
        F.count_if(F.col(column) == value).alias(f"{side}_{name}")
        for side, column in (("actual", y), ("predicted", p))
        for name, value in ((POSITIVE, positive), (NEGATIVE, negative))
    ])
    votes = {
        f"{side}_sentiment": _vote(
            F.col(f"{side}_{POSITIVE}"), F.col(f"{side}_{NEGATIVE}"), POSITIVE, NEGATIVE
        )
        for side in ("actual", "predicted")
    }
    return counts.withColumns(votes)
