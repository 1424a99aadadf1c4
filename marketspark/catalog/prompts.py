"""Prompt texts, splits, balancing, scoring."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.catalog import query, table
from marketspark.operators import prompts, sampling, scoring
from marketspark.plans import evaluation as plans

# The two prompt templates, whole, apart from the library's own copy that they check.
TRAIN_TEXT = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
{}

### Input:
{}

### Response:
{}"""
EVAL_TEXT = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
Given the following market data. Return strictly a single word as prediction value which is 'bullish' if the market is absolutely 'bullish' or 'bearish' if the market is absolutely 'bearish'.", # instruction

### Input:
{}

### Response:
"""


def filled_sql(template: str, *values: str) -> str:
    """SQL for a template with its slots filled by SQL expressions."""
    first, *rest = ("'" + part.replace("'", "''") + "'" for part in template.split("{}"))
    return " || ".join([first, *[f"{value} || {part}" for value, part in zip(values, rest, strict=True)]])


@query("prompt_train", f"""
    select conv_id, turn,
        {filled_sql(TRAIN_TEXT, 'role', 'text', "coalesce(case when role = 'assistant' then turn::varchar end, 'None')")} || '</s>' as text
    from conversations
""")
def prompt_train(spark, folder):
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.col("role").alias("instruction"), F.col("text").alias("input"),
        F.when(F.col("role") == "assistant", F.col("turn")).alias("response"),
    )
    return prompts.train_text(rows, eos="</s>").select("conv_id", "turn", "text")


@query("prompt_eval", f"select event_id, {filled_sql(EVAL_TEXT, 'props')} as text from events")
def prompt_eval(spark, folder):
    return table(spark, folder, "events").select("event_id", prompts.eval_text("props").alias("text"))


@query("extract_response", """
    with g as (select conv_id, turn, case role when 'user' then text || ' ### Response: ' || chr(10) || text || chr(10)
                      when 'assistant' then '### Response:' || text || '### Response: twice' else text end as p
               from conversations)
    select conv_id, turn, regexp_replace(split_part(p, '### Response:', 2), '^\\s+|\\s+$', '', 'g') as response from g
""")
def extract_response(spark, folder):
    text, role = F.col("text"), F.col("role")
    generated = F.when(role == "user", F.concat(text, F.lit(" ### Response: \n"), text, F.lit("\n"))).when(
        role == "assistant", F.concat(F.lit("### Response:"), text, F.lit("### Response: twice"))
    ).otherwise(text)
    return table(spark, folder, "conversations").select(
        "conv_id", "turn", prompts.extract_response(generated).alias("response")
    )


def _token(*keys: str) -> str:
    """The hash by which rows are put in order: every part with its length, a null as ``-``."""
    parts = "".join(f"coalesce(length({k}::varchar) || ':' || {k}, '-') || '|' || " for k in keys)
    return f"md5({parts}'42')"


@query("split_exact", f"""
    select doc_id, case when row_number() over (order by {_token('doc_id')})
        <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split from documents
""")
def split_exact(spark, folder):
    return sampling.split_exact(table(spark, folder, "documents").select("doc_id"), key=["doc_id"])


@query("split_exact_composite", f"""
    with k as (select conv_id, turn, case when turn % 3 > 0 then replace(role, 's', '-') end as a,
                      case when turn % 2 = 0 then conv_id || '-' || turn else turn || '-' || conv_id end as b
               from conversations)
    select conv_id, turn, case when row_number() over (order by {_token('a', 'b', 'conv_id')})
        <= ceil(0.2 * count(*) over ()) then 'test' else 'train' end as split from k
""")
def split_exact_composite(spark, folder):
    """A key of three parts with nulls and with the sign that once joined them."""
    conv, turn = F.col("conv_id").cast("string"), F.col("turn").cast("string")
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.when(F.col("turn") % 3 > 0, F.replace("role", F.lit("s"), F.lit("-"))).alias("a"),
        F.when(F.col("turn") % 2 == 0, F.concat(conv, F.lit("-"), turn)).otherwise(F.concat(turn, F.lit("-"), conv)).alias("b"),
    )
    return sampling.split_exact(rows, key=["a", "b", "conv_id"]).select("conv_id", "turn", "split")


@query("split_hash", f"""
    select event_id, case when ('0x' || substr({_token('event_id')}, 1, 7))::bigint < 53687091
        then 'test' else 'train' end as split from events
""")
def split_hash(spark, folder):
    return sampling.split_hash(table(spark, folder, "events").select("event_id"), key=["event_id"])


def _oversample_sql(source: str, label: str, key: str) -> str:
    return f"""
        with sizes as (select {label} as label, count(*) as n from {source} group by 1),
        short as (select label, n, (select max(n) from sizes) - n as need from sizes where n < (select max(n) from sizes)),
        draws as (select label, n, unnest(range(1, need + 1)) as k from short),
        picks as (select label, ('0x' || substr(md5(concat_ws('-', label, k, '42')), 1, 15))::bigint % n as place from draws),
        placed as (select *, row_number() over (partition by {label}
            order by ('0x' || substr({_token(key)}, 1, 15))::bigint, {key}) - 1 as place from {source})
        select {key}, {label} from {source}
        union all
        select placed.{key}, placed.{label} from picks join placed on placed.{label} = picks.label and placed.place = picks.place
    """


@query("oversample", _oversample_sql("labels", "quality", "doc_id"))
def oversample(spark, folder):
    rows = table(spark, folder, "labels").select("doc_id", "quality")
    return sampling.oversample(rows, label="quality", key=["doc_id"])


@query("oversample_classes", _oversample_sql("orders", "o_orderstatus", "o_orderkey"))
def oversample_classes(spark, folder):
    rows = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus")
    return sampling.oversample(rows, label="o_orderstatus", key=["o_orderkey"])


@query("head_row", "select doc_id, lang from documents order by doc_id limit 1")
def head_row(spark, folder):
    return sampling.head(table(spark, folder, "documents").select("doc_id", "lang"), order=["doc_id"])


@query("sample_rows", f"select event_id, event_type from events order by {_token('event_id')} limit 5000")
def sample_rows(spark, folder):
    rows = table(spark, folder, "events").select("event_id", "event_type")
    return sampling.take_sample(rows, 5000, key=["event_id"])


@query("sample_large", f"select event_id from events order by {_token('event_id')} limit (select count(*) * 9 // 10 from events)")
def sample_large(spark, folder):
    rows = table(spark, folder, "events").select("event_id")
    return sampling.take_sample(rows, rows.count() * 9 // 10, key=["event_id"])


@query("batch_score", """
    select doc_id, case when contains(text, ' the ') then 'bullish' else 'bearish' end as prediction from documents
""")
def batch_score(spark, folder):
    def make_rule():
        """A stand-in model: a text with ' the ' in it is bullish."""
        import numpy as np

        return lambda texts: np.array(["bullish" if " the " in t else "bearish" for t in texts], dtype=object)

    rows = table(spark, folder, "documents").select("doc_id", "text")
    return scoring.batch_predict(rows, make_predict_fn=make_rule, input_col="text").select("doc_id", "prediction")


@query("score_prompts", """
    select conv_id, turn, case when contains(text, ' the ') then 'bullish' else 'bearish' end as prediction
    from conversations
""")
def score_prompts(spark, folder):
    def make_echo():
        """A stand-in model that repeats its prompt and answers by ' the ' in the input."""
        import numpy as np

        def predict(texts):
            bullish = [" the " in t.split("### Input:")[1] for t in texts]
            return np.array([t + ("\nbullish \n" if b else "bearish") for t, b in zip(texts, bullish)], dtype=object)

        return predict

    rows = table(spark, folder, "conversations").select("conv_id", "turn", F.col("text").alias("prompt"))
    return plans.score(rows, make_predict_fn=make_echo).select("conv_id", "turn", "prediction")


@query("training_set", f"""
    with marked as (
        select *, case when role = 'assistant' then 'bullish' else 'bearish' end as response,
               row_number() over (order by {_token('conv_id', 'turn')}) > ceil(0.2 * count(*) over ()) as train
        from conversations
    ),
    texts as (
        select conv_id, turn, train, response, {filled_sql(TRAIN_TEXT, 'role', 'text', 'response')} || '</s>' as text
        from marked
    ),
    sizes as (select response as label, count(*) as n from texts where train group by 1),
    short as (select label, n, (select max(n) from sizes) - n as need from sizes where n < (select max(n) from sizes)),
    draws as (select label, n, unnest(range(1, need + 1)) as k from short),
    picks as (select label, ('0x' || substr(md5(concat_ws('-', label, k, '42')), 1, 15))::bigint % n as place from draws),
    placed as (
        select *, row_number() over (partition by response
            order by ('0x' || substr({_token('conv_id', 'turn')}, 1, 15))::bigint, conv_id, turn) - 1 as place
        from texts where train
    )
    select 'test' as side, text, response from texts where not train
    union all
    select 'train', text, response from texts where train
    union all
    select 'train', text, response from picks join placed on placed.response = picks.label and placed.place = picks.place
""")
def training_set(spark, folder):
    rows = table(spark, folder, "conversations").select(
        "conv_id", "turn", F.col("role").alias("instruction"), F.col("text").alias("input"),
        F.when(F.col("role") == "assistant", "bullish").otherwise("bearish").alias("response"),
    )
    balanced, test = plans.training_set(rows, eos="</s>", key=["conv_id", "turn"])
    sides = [frame.select(F.lit(side).alias("side"), "text", "response") for side, frame in (("train", balanced), ("test", test))]
    return sides[0].unionByName(sides[1])
