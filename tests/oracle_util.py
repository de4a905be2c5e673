"""Compare a Spark DataFrame with a DuckDB query over the same parquet tables."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _canon(v):
    if v is None:
        return "\0null"
    if isinstance(v, float):
        if math.isnan(v):
            return "\0null"
        return repr(float(v))
    if isinstance(v, decimal.Decimal):
        return str(v.normalize())
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime().isoformat()
    if hasattr(v, "item"):
        return _canon(v.item())
    return str(v)


def rows_of_spark(df):
    cols = sorted(df.columns)
    return cols, sorted(tuple(_canon(r[c]) for c in cols) for r in df.select(*cols).collect())


def rows_of_duck(con, sql):
    rel = con.sql(sql)
    names = rel.columns
    data = rel.fetchall()
    cols = sorted(names)
    idx = [names.index(c) for c in cols]
    return cols, sorted(tuple(_canon(row[i]) for i in idx) for row in data)


def compare(df, con, sql):
    s_cols, s_rows = rows_of_spark(df)
    d_cols, d_rows = rows_of_duck(con, sql)
    problems = []
    if s_cols != d_cols:
        problems.append(f"columns differ: spark={s_cols} duckdb={d_cols}")
    if len(s_rows) != len(d_rows):
        problems.append(f"row count differs: spark={len(s_rows)} duckdb={len(d_rows)}")
    elif s_rows != d_rows:
        diff = [(a, b) for a, b in zip(s_rows, d_rows) if a != b][:3]
        problems.append(f"values differ, first: {diff}")
    return problems, len(s_rows)
