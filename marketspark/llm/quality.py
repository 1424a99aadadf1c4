"""Quality rules whose cutoffs reject few good documents, with a guarantee for every stratum."""

from __future__ import annotations

import functools
import operator

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from marketspark.llm.common import BLANKS, bind, kept

#: Words of a repeated window.
WINDOW = 5
#: Fixed by the task.
SYMBOLS = "#*$%&|<>"
MIN_WORDS = 10
MAX_REPEATED = 20

#: A rule rejects what is above its cutoff. The cutoffs to try, from the mildest on, are fixed in advance, so
#: that all labelled documents are a holdout for them; a rule that has no more keeps its last one.
RULES = {
    "symbol_share": [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.06, 0.04, 0.03, 0.02],
    "dup_line_share": [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1],
    "repeat_share": [0.18, 0.16, 0.14, 0.12, 0.1, 0.08, 0.06],
    "word_length": [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0],
}
#: Good documents that all rules together may reject, and the chance that the bound fails anywhere.
RISK = 0.01
DELTA = 0.05


def _repeated(words: Column) -> Column:
    """Words inside windows of five that are found twice or more, each word once.

    The windows' hashes are sorted with their places; equal neighbours repeat. Places back in
    order, each window adds the words up to the next one, five at most.
    """
    def window(hashes, at):
        return F.xxhash64(*[F.get(hashes, at + k) for k in range(WINDOW)])

    def covered(places):
        gaps = F.transform(places, lambda p, i: F.least(F.lit(WINDOW), F.coalesce(F.get(places, i + 1) - p, F.lit(WINDOW))))
        return F.aggregate(gaps, F.lit(0).cast("bigint"), lambda total, x: total + x)

    def twice(found):
        def equal(x, other):
            return F.coalesce(F.get(found, other)["g"] == x["g"], F.lit(False))

        repeated = F.filter(found, lambda x, i: equal(x, i - 1) | equal(x, i + 1))
        return bind(F.array_sort(F.transform(repeated, lambda x: x["i"])), covered)

    def counted(windows):
        placed = F.transform(windows, lambda g, i: F.struct(g.alias("g"), i.alias("i")))
        some = F.size(F.array_distinct(windows)) < F.size(windows)
        return F.when(some, bind(F.array_sort(placed), twice)).otherwise(F.lit(0).cast("bigint"))

    def hashed(hashes):
        places = F.sequence(F.lit(0), F.size(hashes) - WINDOW)
        return bind(F.transform(places, lambda i: window(hashes, i)), counted)

    long_enough = F.size(words) >= WINDOW
    return F.when(long_enough, bind(F.transform(words, lambda w: F.xxhash64(w)), hashed)).otherwise(F.lit(0).cast("bigint"))


def statistics(docs: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang") -> DataFrame:
    """Counts of each document: n_words, word_chars, n_symbols, n_lines, n_dup_lines, n_repeat_words.

    Null texts count as empty; all counts of an empty text are 0. Rows are counted one by one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    words = F.filter(F.split(body, r"[\x20\x09-\x0D]+"), lambda w: w != "")
    by_words = bind(words, lambda w: F.struct(F.size(w).cast("bigint").alias("n"), _repeated(w).alias("repeated")))
    lines = F.filter(F.split(body, "\n"), lambda x: x.rlike(r"[^\x20\x09-\x0D]"))
    by_lines = bind(lines, lambda x: F.struct(
        F.size(x).cast("bigint").alias("n"), (F.size(x) - F.size(F.array_distinct(x))).cast("bigint").alias("dup")))
    rows = docs.select(
        F.col(key).alias("doc_id"), F.col(stratum).alias("stratum"), by_words.alias("_w"), by_lines.alias("_l"),
        F.length(F.translate(body, BLANKS, "")).cast("bigint").alias("word_chars"),
        (F.length(body) - F.length(F.translate(body, SYMBOLS, ""))).cast("bigint").alias("n_symbols"),
    )
    return rows.select(
        "doc_id", "stratum", F.col("_w.n").alias("n_words"), "word_chars", "n_symbols",
        F.col("_l.n").alias("n_lines"), F.col("_l.dup").alias("n_dup_lines"), F.col("_w.repeated").alias("n_repeat_words"),
    )


def measures() -> dict[str, Column]:
    """The measure of each rule from the counts; 0 where there is nothing to divide by."""
    def over(a, b):
        return F.coalesce(F.col(a) / F.nullif(F.col(b), F.lit(0)), F.lit(0.0))

    return {
        "symbol_share": over("n_symbols", "word_chars"), "dup_line_share": over("n_dup_lines", "n_lines"),
        "repeat_share": over("n_repeat_words", "n_words"), "word_length": over("word_chars", "n_words"),
    }


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEATED)


def binomial_tail(n: Column, k: Column, risk: float) -> Column:
    """P(X <= k) for X binomial (n, risk), summed term by term in logarithms."""
    odds = F.lit(risk / (1.0 - risk))
    start = F.struct((n * F.log(F.lit(1.0 - risk))).alias("term"), (n * F.log(F.lit(1.0 - risk))).alias("sum"))

    def add(so_far, j):
        term = so_far["term"] + F.log((n - j + 1) / j * odds)
        high, low = F.greatest(so_far["sum"], term), F.least(so_far["sum"], term)
        return F.struct(term.alias("term"), (high + F.log1p(F.exp(low - high))).alias("sum"))

    steps = F.when(k > 0, F.sequence(F.lit(1).cast("bigint"), k)).otherwise(F.array().cast("array<bigint>"))
    return F.exp(F.aggregate(steps, start, add)["sum"])


def levels(rules: dict[str, list[float]]) -> list[dict[str, float]]:
    """The cutoffs of all rules level by level, from the mildest to the strictest."""
    ordered = {name: sorted(values, reverse=True) for name, values in rules.items()}
    return [{name: values[min(i, len(values) - 1)] for name, values in ordered.items()} for i in range(max(map(len, ordered.values())))]


def cutoffs(counts: DataFrame, labels: DataFrame, *, key: str = "doc_id", good: str = "quality",
            risk: float = RISK, delta: float = DELTA, rules: dict[str, list[float]] = RULES) -> DataFrame:
    """One row a stratum with a proof, one column a rule: the strictest cutoffs proven safe.

    All rules are tested together, level by level from the mildest on, in every stratum. The hypothesis "at
    this level the rules together reject more than ``risk`` of the good documents" is refuted if, at
    that rate, so few rejections among the good labelled documents have a probability of at most
    ``delta / strata``, by the exact binomial. The first level that is not refuted ends the sequence, so
    the sequence needs no further correction; Bonferroni covers the strata. A stratum needs
    ln(delta / strata) / ln(1 - risk) good labels at least, 436 for 4 strata.

    A document is good if all its labels say 1. Strata without labels get no row, so no rule.
    """
    steps = levels(rules)
    truth = labels.groupBy(F.col(key).alias("_id")).agg(F.min(F.col(good)).alias("_good")).where(F.col("_good") == 1)
    measured = counts.where(~base_failed()).select("doc_id", "stratum", *[m.alias(n) for n, m in measures().items() if n in rules])
    holdout = measured.join(truth, F.col("doc_id") == F.col("_id"))

    def rejected(level: dict[str, float]) -> Column:
        return functools.reduce(operator.or_, [F.col(name) > cut for name, cut in level.items()])

    per_stratum = holdout.groupBy("stratum").agg(
        F.count(F.lit(1)).alias("n"), *[F.count(F.when(rejected(level), 1)).alias(f"k{i}") for i, level in enumerate(steps)]
    )
    strata = F.count(F.lit(1)).over(Window.partitionBy())
    cells = F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"k{i}").alias("k")) for i in range(len(steps))])
    listed = per_stratum.select("stratum", "n", strata.alias("strata"), F.explode(cells).alias("c")).select("stratum", "n", "strata", "c.*")
    tail = F.when(F.col("k") < F.col("n") * risk, binomial_tail(F.col("n"), F.col("k"), risk)).otherwise(F.lit(1.0))
    judged = listed.withColumn("safe", tail <= F.lit(delta) / F.col("strata"))
    so_far = Window.partitionBy("stratum").orderBy("i")
    proven = judged.withColumn("all_safe", F.min("safe").over(so_far)).where("all_safe").groupBy("stratum").agg(F.max("i").alias("i"))
    chosen = F.array(*[F.struct(*[F.lit(level[name]).alias(name) for name in rules]) for level in steps])
    return proven.withColumn("c", F.get(chosen, F.col("i"))).select("stratum", "c.*")


def judge(docs: DataFrame, labels: DataFrame, *, key: str = "doc_id", text: str = "text", stratum: str = "lang",
          good: str = "quality", risk: float = RISK, delta: float = DELTA, rules: dict[str, list[float]] = RULES) -> DataFrame:
    """The counts of every document, base_failed and kept.

    Kept is false if the base rule fails or a measure is above its stratum's proven cutoff. A null
    stratum is a stratum of its own. Null and empty texts fail the base rule. Rows of one key are judged
    one by one. Without labels only the base rule works. An empty table gives no rows.
    """
    counts = kept(statistics(docs, key=key, text=text, stratum=stratum), "quality-counts")
    limits = kept(cutoffs(counts, labels, key=key, good=good, risk=risk, delta=delta, rules=rules), "quality-cutoffs")
    limits = limits.select(F.col("stratum").alias("_s"), *[F.col(name).alias(f"_{name}") for name in rules])
    above = F.lit(False)
    for name, measure in measures().items():
        if name in rules:
            above = above | F.coalesce(measure > F.col(f"_{name}"), F.lit(False))
    joined = counts.join(limits, F.col("stratum").eqNullSafe(F.col("_s")), "left")
    judged = joined.withColumn("base_failed", base_failed())
    return judged.withColumn("kept", ~F.col("base_failed") & ~above).select(*counts.columns, "base_failed", "kept")
