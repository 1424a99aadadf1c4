"""The two date formats of news pages."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marketspark.functions.text import strip

# The marker, the two input formats and the output format.
UPDATED_MARK = "Last Updated:"
UPDATED_FORMAT = "MMM d, yyyy, h:m:s a 'IST'"
ISO_FORMAT = "yyyy-M-d'T'H:m:s.SSSSSS'Z'"
OUTPUT_FORMAT = "dd-MM-yyyy"


def news_date(column: Column) -> Column:
    """DATE of a page date in either format, null for anything else. Zones are plain text."""
    updated = strip(F.replace(column, F.lit(UPDATED_MARK), F.lit("")))
    return F.when(
        column.contains(UPDATED_MARK), F.to_date(F.try_to_timestamp(updated, F.lit(UPDATED_FORMAT)))
    ).otherwise(F.to_date(F.try_to_timestamp(column, F.lit(ISO_FORMAT))))


def normalize_date(column: Column) -> Column:
    """``dd-MM-yyyy`` text of a page date."""
    return F.date_format(news_date(column), OUTPUT_FORMAT)
