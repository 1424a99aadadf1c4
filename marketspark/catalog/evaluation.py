"""Counts, metrics and curves over the labels."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.catalog import query, r6, table
from marketspark.operators import evaluation as E
from marketspark.plans.evaluation import report


def _judged(spark, folder):
    """Truth (quality) and prediction (not toxic) as the two labels."""
    def word(c):
        return F.when(c == 1, E.POSITIVE).otherwise(E.NEGATIVE)

    labels = table(spark, folder, "labels")
    return labels.select("doc_id", word(F.col("quality")).alias("y"), word(1 - F.col("toxic")).alias("p"))


JUDGED = """(select doc_id, case quality when 1 then 'bullish' else 'bearish' end as y,
             case 1 - toxic when 1 then 'bullish' else 'bearish' end as p from labels)"""


@query("value_counts", "select event_type, count(*)::bigint as n from events where event_type <> 'view' group by 1")
def value_counts(spark, folder):
    rows = table(spark, folder, "events").select(
        F.when(F.col("event_type") != "view", F.col("event_type")).alias("event_type")
    )
    return E.value_counts(rows, "event_type")


@query("row_counts", "select count(*)::bigint as n_rows, ceil(count(*) / 16.0)::bigint as n_batches from documents")
def row_counts(spark, folder):
    return E.row_counts(table(spark, folder, "documents"))


@query("confusion_cells", f"select y as truth, p as predicted, count(*)::bigint as n from {JUDGED} group by 1, 2")
def confusion_cells(spark, folder):
    return E.confusion_cells(_judged(spark, folder), y="y", p="p")


@query("confusion_matrix", f"""
    with j as {JUDGED}, l as (select unnest(['bearish', 'bullish', 'other']) as label)
    select a.label as truth, b.label as predicted, count(j.y)::bigint as n
    from l a cross join l b left join j on j.y = a.label and j.p = b.label group by 1, 2
""")
def confusion_matrix(spark, folder):
    return E.confusion_matrix(_judged(spark, folder), y="y", p="p", labels=["bearish", "bullish"])


@query("binary_metrics", f"""
    with c as (select count(*) as n, count_if(y = p) as hits, count_if(y = 'bullish' and p = 'bullish') as tp,
                      count_if(p = 'bullish') as called, count_if(y = 'bullish') as actual from {JUDGED}),
         m as (select hits / n as accuracy, coalesce(tp / nullif(called, 0), 0.0) as precision,
                      coalesce(tp / nullif(actual, 0), 0.0) as recall from c)
    select round(accuracy, 6) as accuracy, round(precision, 6) as precision, round(recall, 6) as recall,
           round(coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0), 6) as f1,
           0::bigint as n_unmapped from m
""")
def binary_metrics(spark, folder):
    scored = E.binary_metrics(_judged(spark, folder), y="y", p="p")
    return scored.select(*[r6(c).alias(c) for c in ("accuracy", "precision", "recall", "f1")], "n_unmapped")


@query("class_report", f"""
    with j as {JUDGED}, l as (select y as label from j union select p from j),
    c as (select label, count_if(y = label and p = label) as tp, count_if(p = label) as called,
                 count_if(y = label) as support from l, j group by 1),
    m as (select label, support, tp, coalesce(tp / nullif(called, 0), 0.0) as precision,
                 coalesce(tp / nullif(support, 0), 0.0) as recall from c),
    f as (select *, coalesce(2 * precision * recall / nullif(precision + recall, 0), 0.0) as f1 from m),
    r as (
        select label, precision, recall, f1, support from f
        union all
        select 'accuracy', sum(tp) / sum(support), sum(tp) / sum(support), sum(tp) / sum(support), sum(support) from f
        union all
        select 'macro avg', avg(precision), avg(recall), avg(f1), sum(support) from f
        union all
        select 'weighted avg', sum(precision * support) / sum(support), sum(recall * support) / sum(support),
               sum(f1 * support) / sum(support), sum(support) from f
    )
    select label, round(precision, 6) as precision, round(recall, 6) as recall, round(f1, 6) as f1,
           support::bigint as support from r
""")
def class_report(spark, folder):
    report = E.class_report(_judged(spark, folder), y="y", p="p")
    return report.select("label", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], "support")


@query("overall_sentiment", f"""
    with c as (select count_if(y = 'bullish')::bigint as actual_bullish, count_if(y = 'bearish')::bigint as actual_bearish,
                      count_if(p = 'bullish')::bigint as predicted_bullish,
                      count_if(p = 'bearish')::bigint as predicted_bearish from {JUDGED})
    select *, case when actual_bullish > actual_bearish then 'bullish'
                   when actual_bearish > actual_bullish then 'bearish' else 'neutral' end as actual_sentiment,
              case when predicted_bullish > predicted_bearish then 'bullish'
                   when predicted_bearish > predicted_bullish then 'bearish' else 'neutral' end as predicted_sentiment
    from c
""")
def overall_sentiment(spark, folder):
    return E.overall_sentiment(_judged(spark, folder), y="y", p="p")


def _scored(spark, folder):
    """Quality of each labelled document with its length as the score."""
    docs = table(spark, folder, "documents").select("doc_id", F.col("n_chars").cast("double").alias("score"))
    return table(spark, folder, "labels").join(docs, "doc_id").select("doc_id", "quality", "score")


CURVE = {"y": "quality", "score": "score"}
CURVE_SQL = """
    with j as (select quality, n_chars::double as score from labels join documents using (doc_id)),
    g as (select score, count_if(quality = 1) as pos, count_if(quality <> 1) as neg from j group by 1),
    r as (select score, pos, neg, sum(pos) over (order by score desc) as tps, sum(neg) over (order by score desc) as fps,
                 sum(pos) over () as p, sum(neg) over () as n,
                 lead(pos) over (order by score desc) as pos1, lead(neg) over (order by score desc) as neg1,
                 row_number() over (order by score desc) as i from g)
"""


@query("roc_points", CURVE_SQL + """
    select null::double as threshold, 0.0::double as fpr, 0.0::double as tpr
    union all select score, round(fps / n, 6), round(tps / p, 6) from r
""")
def roc_points(spark, folder):
    points = E.roc_points(_scored(spark, folder), **CURVE)
    return points.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("roc_corner_points", CURVE_SQL + """
    select null::double as threshold, 0.0::double as fpr, 0.0::double as tpr
    union all select score, round(fps / n, 6), round(tps / p, 6) from r
    where i = 1 or pos1 is null or pos1 <> pos or neg1 <> neg
""")
def roc_corner_points(spark, folder):
    points = E.roc_points(_scored(spark, folder), **CURVE, drop_intermediate=True, block_rows=50)
    return points.select("threshold", r6("fpr").alias("fpr"), r6("tpr").alias("tpr"))


@query("roc_auc", CURVE_SQL + "select round(sum(neg * (2 * tps - pos) / 2) / (max(p) * max(n)), 6) as roc_auc from r")
def roc_auc(spark, folder):
    return E.roc_auc(_scored(spark, folder), **CURVE).select(r6("roc_auc").alias("roc_auc"))


@query("pr_points", CURVE_SQL + """
    select null::double as threshold, 1.0::double as precision, 0.0::double as recall
    union all select score, round(tps / (tps + fps), 6), round(tps / p, 6) from r
""")
def pr_points(spark, folder):
    points = E.pr_points(_scored(spark, folder), **CURVE)
    return points.select("threshold", r6("precision").alias("precision"), r6("recall").alias("recall"))


@query("avg_precision", CURVE_SQL + """
    select round(sum(pos / p * tps / (tps + fps)), 6) as average_precision from r
""")
def avg_precision(spark, folder):
    result = E.average_precision(_scored(spark, folder), **CURVE, block_rows=50)
    return result.select(r6("average_precision").alias("average_precision"))


@query("event_roc_auc", """
    with g as (select value as score, count_if(event_type = 'purchase') as pos,
                      count_if(event_type <> 'purchase') as neg from events group by 1),
    r as (select *, sum(pos) over (order by score desc) as tps from g)
    select round(sum(neg * (2 * tps - pos) / 2) / (sum(pos) * sum(neg)), 6) as roc_auc from r
""")
def event_roc_auc(spark, folder):
    result = E.roc_auc(
        table(spark, folder, "events"), y="event_type", score="value", positive="purchase"
    )
    return result.select(r6("roc_auc").alias("roc_auc"))


UNMAPPED_SQL = """
    with j as (select case when toxic = 0 then quality end as y, case when n_chars > 60 then n_chars::double end as score
               from labels join documents using (doc_id)),
    g as (select score, count_if(y = 1) as pos, count_if(y <> 1) as neg from j where y is not null and score is not null group by 1),
    r as (select score, pos, neg, sum(pos) over (order by score desc) as tps, sum(neg) over (order by score desc) as fps,
                 sum(pos) over () as p, sum(neg) over () as n from g),
    u as (select count(*)::bigint as n_unmapped from j where y is null or score is null)
"""


def _half_mapped(spark, folder):
    """Toxic documents have no truth and very short ones no score."""
    rows = _scored(spark, folder).join(table(spark, folder, "labels").select("doc_id", "toxic"), "doc_id")
    return rows.select(
        F.when(F.col("toxic") == 0, F.col("quality")).alias("quality"), F.when(F.col("score") > 60, F.col("score")).alias("score")
    )


@query("roc_unmapped", UNMAPPED_SQL + """
    select round((select sum(neg * (2 * tps - pos) / 2) / (max(p) * max(n)) from r), 6) as roc_auc, n_unmapped from u
""")
def roc_unmapped(spark, folder):
    return E.roc_auc(_half_mapped(spark, folder), **CURVE).select(r6("roc_auc").alias("roc_auc"), "n_unmapped")


@query("pr_unmapped", UNMAPPED_SQL + """
    select round((select sum(pos / p * tps / (tps + fps)) from r), 6) as average_precision, n_unmapped from u
""")
def pr_unmapped(spark, folder):
    result = E.average_precision(_half_mapped(spark, folder), **CURVE)
    return result.select(r6("average_precision").alias("average_precision"), "n_unmapped")


@query("report_free_text", """
    with j as (select case when quality = 1 then 'bullish' else 'bearish' end as y,
                      case when lang = 'en' then 'bullish' when lang = 'de' then 'bearish' else 'other' end as p
               from labels join documents using (doc_id)),
    l as (select unnest(['bearish', 'bullish', 'other']) as label)
    select a.label as truth, b.label as predicted, count(j.y)::bigint as n
    from l a cross join l b left join j on j.y = a.label and j.p = b.label group by 1, 2
""")
def report_free_text(spark, folder):
    """The matrix of a report on a model that answers with as many texts as there are documents."""
    docs = table(spark, folder, "documents")
    answer = F.when(F.col("lang") == "en", "bullish").when(F.col("lang") == "de", "bearish").otherwise(F.col("text"))
    rows = table(spark, folder, "labels").join(docs, "doc_id").select(
        F.when(F.col("quality") == 1, "bullish").otherwise("bearish").alias("target"), answer.alias("prediction")
    )
    return report(rows)["confusion_matrix"]
