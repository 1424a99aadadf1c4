"""Scans of the file formats: each query writes a table in the format and reads it back."""

from __future__ import annotations

from pyspark.sql import functions as F

from marketspark.catalog import query, table
from marketspark import schemas
from marketspark.operators import reshape
from marketspark.session import scratch_path
from marketspark.sources import files, store


@query("companies_xml", """
    select s_name as ticker, 'a&b <' || s_suppkey || '>' as ticker_name, lpad(s_suppkey::varchar, 8, '0') as cid from supplier
""")
def companies_xml(spark, folder):
    path = scratch_path(spark, "companies")
    table(spark, folder, "supplier").select(
        F.col("s_name").alias("Ticker"),
        F.concat(F.lit("a&b <"), F.col("s_suppkey").cast("string"), F.lit(">")).alias("Ticker_Name"),
        F.lpad(F.col("s_suppkey").cast("string"), 8, "0").alias("CID"),
    ).write.format("xml").option("rootTag", "Companies").option("rowTag", "Company").save(path)
    return files.read_companies(spark, path).drop("ordinal")


@query("train_jsonl", """
    select role as instruction, text as input, case when role = 'assistant' then turn::varchar end as response
    from conversations
""")
def train_jsonl(spark, folder):
    path = scratch_path(spark, "train")
    rows = table(spark, folder, "conversations").select(
        F.col("role").alias("instruction"), F.col("text").alias("input"),
        F.when(F.col("role") == "assistant", F.col("turn").cast("string")).alias("response"),
    )
    store.write_jsonl(rows, path)
    return files.read_train_jsonl(spark, path)


@query("bad_jsonl_lines", """
    select '{"instruction": broken ' || conv_id || '-' || turn as line from conversations where role = 'user'
""")
def bad_jsonl_lines(spark, folder):
    path = scratch_path(spark, "broken")
    rows = table(spark, folder, "conversations")
    good = F.to_json(F.struct(F.col("role").alias("instruction"), F.col("text").alias("input")))
    broken = F.concat(
        F.lit('{"instruction": broken '), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
    )
    rows.select(F.when(F.col("role") == "user", broken).otherwise(good).alias("value")).write.text(path)
    return files.bad_rows(files.read_jsonl(spark, path, schemas.TRAIN_JSONL))


@query("test_csv", """
    select conv_id || chr(10) || text || ' "' || role || '", ' || turn as prompt, role as target from conversations
""")
def test_csv(spark, folder):
    path = scratch_path(spark, "test")
    prompt = F.concat(
        F.col("conv_id").cast("string"), F.lit("\n"), "text", F.lit(' "'), "role", F.lit('", '), F.col("turn").cast("string")
    )
    rows = table(spark, folder, "conversations").select(prompt.alias("Prompt"), F.col("role").alias("Target"))
    store.write_csv(rows, path)
    return files.read_test_csv(spark, path)


@query("test_csv_split", """
    select conv_id || chr(10) || text || ' "' || role || '", ' || turn as prompt, role as target from conversations
""")
def test_csv_split(spark, folder):
    """Files with newlines and doubled quotes in their fields, each read by many tasks."""
    path = scratch_path(spark, "split")
    prompt = F.concat(
        F.col("conv_id").cast("string"), F.lit("\n"), "text", F.lit(' "'), "role", F.lit('", '), F.col("turn").cast("string")
    )
    rows = table(spark, folder, "conversations").select(prompt.alias("Prompt"), F.col("role").alias("Target"))
    store.write_csv(rows, path)
    return files.read_test_csv_split(spark, path, chunk_bytes=1 << 18)


@query("test_csv_reordered", """
    select conv_id || ' "' || role || '", ' || turn as prompt, role as target from conversations
""")
def test_csv_reordered(spark, folder):
    """A file with a number in front and the target before the prompt, as a table export writes it."""
    path = scratch_path(spark, "reordered")
    prompt = F.concat(F.col("conv_id").cast("string"), F.lit(' "'), "role", F.lit('", '), F.col("turn").cast("string"))
    rows = table(spark, folder, "conversations").select(
        F.col("conv_id").alias("Number"), F.col("role").alias("Target"), prompt.alias("Prompt")
    )
    store.write_csv(rows, path)
    return files.read_test_csv(spark, path)


@query("jsonl_errors", """
    select 'line' as part, '{"instruction": broken ' || conv_id || '-' || turn as value from conversations where role = 'user'
    union all
    select 'input', text from conversations where role <> 'user'
""")
def jsonl_errors(spark, folder):
    """Good lines and broken ones of one folder, each in its table."""
    path = scratch_path(spark, "mixed")
    good = F.to_json(F.struct(F.col("role").alias("instruction"), F.col("text").alias("input")))
    broken = F.concat(
        F.lit('{"instruction": broken '), F.col("conv_id").cast("string"), F.lit("-"), F.col("turn").cast("string")
    )
    table(spark, folder, "conversations").select(
        F.when(F.col("role") == "user", broken).otherwise(good).alias("value")
    ).write.text(path)
    lines = files.bad_rows(files.read_jsonl(spark, path, schemas.TRAIN_JSONL)).select(F.lit("line").alias("part"), F.col("line").alias("value"))
    rows = files.read_train_jsonl(spark, path, on_error="skip")
    return lines.unionByName(rows.select(F.lit("input").alias("part"), F.col("input").alias("value")))


@query("empty_source", """
    select o_orderkey as ordinal, 'Stock' as asset_type from orders where o_orderstatus = 'F'
""")
def empty_source(spark, folder):
    """A source without data put together with one that has rows."""
    rows = table(spark, folder, "orders").where(F.col("o_orderstatus") == "F").select(
        F.col("o_orderkey").alias("ordinal"), F.lit(schemas.STOCK).alias("asset_type")
    )
    return reshape.union_all(files.empty(spark, schemas.PRICE_HISTORY), rows).select("ordinal", "asset_type")


@query("history_since", """
    select o_orderkey as ordinal, case o_orderstatus when 'F' then 'Stock' else 'Index' end as asset_type from orders
    where o_orderstatus in ('F', 'O') and o_orderdate::date >= date '1996-01-01'
    union all
    select o_orderkey, 'ETF' from orders where o_orderstatus = 'P' and o_orderdate::date <= date '1997-12-31'
""")
def history_since(spark, folder):
    """Ranges with one open end."""
    path = scratch_path(spark, "orders")
    kind = F.when(F.col("o_orderstatus") == "F", schemas.STOCK).when(F.col("o_orderstatus") == "P", schemas.ETF)
    store.write_store(table(spark, folder, "orders").select(
        F.col("o_orderkey").alias("ordinal"), F.col("o_custkey").cast("string").alias("ticker"),
        kind.otherwise(schemas.INDEX).alias("asset_type"), F.col("o_orderdate").cast("date").alias("trade_date"),
    ), path)
    since = [files.read_history(spark, path, asset_type=a, start="1996-01-01") for a in (schemas.STOCK, schemas.INDEX)]
    upto = files.read_history(spark, path, asset_type=schemas.ETF, end="1997-12-31")
    return reshape.union_all(*since, upto).select("ordinal", "asset_type")
