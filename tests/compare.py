"""Order-insensitive comparison of a query with its SQL."""

import glob
import math
import os

import duckdb


def connect(folder):
    con = duckdb.connect()
    con.execute("set threads to 8")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"create view {name} as select * from '{path}'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return f"{type(value).__name__}:{value}"


def rows_by_name(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    table = [tuple(plain(r[i]) for i in order) for r in rows]
    return names, sorted(table, key=lambda t: [(v is None, v or "") for v in t])


def spark_rows(df):
    return rows_by_name(df.columns, [tuple(r) for r in df.collect()])


def sql_rows(con, sql):
    result = con.execute(sql)
    return rows_by_name([d[0] for d in result.description], result.fetchall())
