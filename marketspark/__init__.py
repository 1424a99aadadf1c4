"""Market data, news and prompt analytics as lazy PySpark DataFrames."""
