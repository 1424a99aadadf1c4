"""Batch scoring with a model the caller brings."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.ml.functions import predict_batch_udf
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marketspark.operators.prompts import extract_response

# Fixed value: rows per model call.
BATCH_SIZE = 16


def batch_predict(
    df: DataFrame, *, make_predict_fn: Callable, input_col: str, output_col: str = "prediction",
    return_type: T.DataType = T.StringType(), batch_size: int = BATCH_SIZE,
) -> DataFrame:
    """Add the model's output next to each row, in batches; the model is made once per worker."""
    predict = predict_batch_udf(make_predict_fn, return_type=return_type, batch_size=batch_size)
    return df.withColumn(output_col, predict(F.col(input_col)))


def answer(df: DataFrame, *, generated: str, name: str = "prediction") -> DataFrame:
    """The answer part of a generated text that repeats its prompt."""
    return df.withColumn(name, extract_response(F.col(generated)))
