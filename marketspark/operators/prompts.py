"""Prompt texts and the answer inside a generated text."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marketspark.functions.text import as_text, part_after

# The two prompt templates, byte for byte, and the mark in front of the answer.
TRAIN_TEMPLATE = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
{}

### Input:
{}

### Response:
{}"""
EVAL_TEMPLATE = """Below is an instruction that describes a task, paired with an input that provides further context. Write a response that appropriately completes the request.

### Instruction:
Given the following market data. Return strictly a single word as prediction value which is 'bullish' if the market is absolutely 'bullish' or 'bearish' if the market is absolutely 'bearish'.", # instruction

### Input:
{}

### Response:
"""
RESPONSE_MARK = "### Response:"


def _filled(template: str, *slots: Column | str) -> Column:
    """The template with its slots filled in order; a missing value reads ``None``."""
    first, *rest = template.split("{}")
    texts = [as_text(F.col(s) if isinstance(s, str) else s) for s in slots]
    return F.concat(F.lit(first), *[x for text, part in zip(texts, rest) for x in (text, F.lit(part))])


def train_text(
    df: DataFrame, *, eos: str, instruction: str = "instruction", input: str = "input",
    response: str = "response", name: str = "text",
) -> DataFrame:
    """Training text of each row, closed with the end mark of the tokenizer in use."""
    text = _filled(TRAIN_TEMPLATE, instruction, input, response)
    return df.withColumn(name, F.concat(text, F.lit(eos)))


def eval_text(prompt: Column | str) -> Column:
    """Evaluation text around a line of market data."""
    return _filled(EVAL_TEMPLATE, prompt)


def extract_response(generated: Column) -> Column:
    """What follows the first response mark, up to a second one; empty without a mark."""
    return part_after(generated, RESPONSE_MARK)
