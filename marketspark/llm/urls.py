"""URL filters: host and path rules first, boosted trees on lexical features for the rest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.llm.common import draw, kept

ALLOW, BLOCK = "allow", "block"
#: Fixed by the task: verdict, host, start of the path.
RULES = (
    (ALLOW, "org", "/"),
    (BLOCK, "example.org", "/es/"),
    (BLOCK, "example.org", "/en/1"),
    (ALLOW, "com", "/fr/"),
    (BLOCK, "com", "/de/"),
)
#: Most labelled URLs that the trees are fitted on, in the mean of the draw.
TRAIN_ROWS = 20_000
SUFFIX_PRIOR = 10.0
A_TO_Z = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def host(url: Column) -> Column:
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, A_TO_Z, A_TO_Z.lower())


def path(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def matched_rule(rules: Sequence[tuple[str, str, str]], host: Column, path: Column) -> Column:
    """Verdict and text of the longest rule that fits, or null; a struct."""
    longest = sorted(rules, key=lambda r: (-len(r[1] + r[2]), r))
    fits = [
        F.when(((host == h) | host.endswith("." + h)) & path.startswith(p), F.struct(F.lit(v).alias("verdict"), F.lit(h + p).alias("rule")))
        for v, h, p in longest
    ]
    return F.coalesce(*fits, F.lit(None).cast("struct<verdict:string,rule:string>"))


def _count(text: Column, characters: str) -> Column:
    return (F.length(text) - F.length(F.translate(text, characters, ""))).cast("double")


def _entropy(text: Column) -> Column:
    """Bits a character of the text's own character frequencies."""
    each = F.transform(
        F.array_distinct(F.split(text, "")), lambda c: (F.length(text) - F.length(F.replace(text, c, F.lit("")))) / F.length(text)
    )
    bits = F.aggregate(each, F.lit(0.0), lambda total, p: total - F.when(p > 0, p * F.log2(p)).otherwise(0.0))
    return F.when(F.length(text) > 0, bits).otherwise(F.lit(0.0))


def features(url: Column, host: Column, path: Column) -> dict[str, Column]:
    """Lexical features, none of them null."""
    url = F.coalesce(url, F.lit(""))
    query = F.regexp_extract(url, r"(?s)\?([^#]*)", 1)
    size = F.greatest(F.length(url), F.lit(1)).cast("double")
    return {
        "length": F.length(url).cast("double"),
        "host_length": F.length(host).cast("double"),
        "path_length": F.length(path).cast("double"),
        "depth": _count(path, "/"),
        "labels": _count(host, "."),
        "digit_share": _count(url, "0123456789") / size,
        "host_digits": _count(host, "0123456789"),
        "path_digits": _count(path, "0123456789"),
        "dashes": _count(url, "-"),
        "underscores": _count(url, "_"),
        "escapes": _count(url, "%"),
        "parameters": _count(query, "="),
        "separators": _count(query, "&;"),
        "entropy": _entropy(url),
        "path_entropy": _entropy(path),
        "longest_part": F.coalesce(F.array_max(F.transform(F.split(path, "/"), lambda p: F.length(p))), F.lit(0)).cast("double"),
        "dotted_end": F.when(path.rlike(r"\.[A-Za-z0-9]{1,5}$"), 1.0).otherwise(0.0),
        "secure": F.when(url.startswith("https"), 1.0).otherwise(0.0),
    }


def suffix(host: Column) -> Column:
    return F.substring_index(host, ".", -1)


class UrlFilter:
    """Trees and suffix statistics fitted on labelled URLs, or one verdict where there is no choice."""

    def __init__(self, constant: str, suffixes: DataFrame | None = None, mean: float = 0.0):
        self.model, self.suffixes, self.mean, self.constant = None, suffixes, mean, constant

    @classmethod
    def fit(cls, labelled: DataFrame, *, rows: int = TRAIN_ROWS, rounds: int = 12, depth: int = 4, seed: int = 5) -> UrlFilter:
        """Fit on ``labelled`` (url, verdict): each different URL once, about ``rows`` of them at most.

        URLs are drawn by their hash, so the sample does not depend on the partitioning. With one
        verdict only, that is the answer for all; with no label it is allow.
        """
        distinct = labelled.where(F.col("url").isNotNull()).groupBy("url").agg(F.min("verdict").alias("verdict"))
        distinct = kept(distinct, "url-labels")
        classes = {r["verdict"]: r["n"] for r in distinct.groupBy("verdict").agg(F.count(F.lit(1)).alias("n")).collect()}
        if len(classes) < 2:
            return cls(next(iter(classes), ALLOW))
        sample = distinct.where(draw(F.col("url"), seed) < F.lit(min(1.0, rows / sum(classes.values()))))
        sample = kept(sample.withColumn("host", host(F.col("url"))).withColumn("label", F.when(F.col("verdict") == BLOCK, 1.0).otherwise(0.0)), "url-sample")
        whole = sample.agg(F.avg("label").alias("mean")).first()["mean"]
        if whole is None or whole in (0.0, 1.0):
            return cls(max(classes, key=lambda v: (classes[v], v)))
        suffixes = sample.groupBy(suffix(F.col("host")).alias("_suffix")).agg(
            F.count(F.lit(1)).alias("_n"), F.sum("label").alias("_blocked")
        ).select("_suffix", F.log1p(F.col("_n").cast("double")).alias("suffix_count"),
                 ((F.col("_blocked") + whole * SUFFIX_PRIOR) / (F.col("_n") + SUFFIX_PRIOR)).alias("suffix_blocked"))
        made = cls(ALLOW, kept(suffixes, "url-suffixes"), whole)
        train = kept(made._vectors(sample.withColumn("path", path(F.col("url")))).select("features", "label"), "url-vectors")
        trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=rounds, maxDepth=depth, maxBins=32, seed=seed)
        made.model = trees.fit(train)
        return made

    def _vectors(self, rows: DataFrame) -> DataFrame:
        """``rows`` (url, host, path) with the feature vector; suffixes come from the bounded sample."""
        named = features(F.col("url"), F.col("host"), F.col("path"))
        joined = rows.join(self.suffixes, suffix(F.col("host")) == F.col("_suffix"), "left").drop("_suffix")
        joined = joined.withColumn("suffix_count", F.coalesce("suffix_count", F.lit(0.0)))
        joined = joined.withColumn("suffix_blocked", F.coalesce("suffix_blocked", F.lit(self.mean)))
        joined = joined.withColumns({f"_x_{k}": v for k, v in named.items()})
        columns = [*[f"_x_{k}" for k in named], "suffix_count", "suffix_blocked"]
        return VectorAssembler(inputCols=columns, outputCol="features").transform(joined).drop(*columns)

    def judge(self, rows: DataFrame) -> DataFrame:
        """``rows`` (key columns, url, host, path) with ``judged``: allow or block."""
        if self.model is None:
            return rows.withColumn("judged", F.lit(self.constant))
        scored = self.model.transform(self._vectors(rows)).drop("features", "rawPrediction", "probability")
        return scored.withColumn("judged", F.when(F.col("prediction") > 0.5, BLOCK).otherwise(ALLOW)).drop("prediction")


def filter_urls(pages: DataFrame, *, key: str = "page_id", url: str = "url", rules: Sequence[tuple[str, str, str]] = RULES,
                labelled: DataFrame | None = None, rows: int = TRAIN_ROWS) -> DataFrame:
    """page_id, host, path, rule and verdict of every row.

    A rule fits a host and its subdomains where the path starts with the rule's; the longest wins.
    URLs without a rule are judged by the trees. They learn from ``labelled`` (url, verdict), by
    default from the URLs that a rule decides. A null URL, or one without ``://``, has an empty host
    and path and is judged like any other. Repeated rows are judged alike; other columns are
    not looked at; an empty table gives no rows.
    """
    parts = pages.select(F.col(key).alias("page_id"), F.col(url).alias("url"))
    parts = parts.withColumn("host", host(F.col("url"))).withColumn("path", path(F.col("url")))
    parts = kept(parts.withColumn("matched", matched_rule(rules, F.col("host"), F.col("path"))), "url-parts")
    if labelled is None:
        labelled = parts.where("matched is not null").select("url", F.col("matched.verdict").alias("verdict"))
    fitted = UrlFilter.fit(labelled, rows=rows)
    decided = parts.where("matched is not null").select("page_id", "host", "path", F.col("matched.rule").alias("rule"), F.col("matched.verdict").alias("verdict"))
    left = parts.where("matched is null").select("page_id", "url", "host", "path")
    judged = fitted.judge(left).select("page_id", "host", "path", F.lit(None).cast("string").alias("rule"), F.col("judged").alias("verdict"))
    return decided.unionByName(judged)
