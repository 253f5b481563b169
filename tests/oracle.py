"""Local stand-in for the driver's correctness gate: run a Spark query and its
DuckDB oracle on the same parquet tables and compare rows, columns, values."""

from __future__ import annotations

import datetime as dt
import decimal
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents "
          "embeddings pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v, digits=6):
    if v is None:
        return None
    if isinstance(v, bool):
        return int(v)
    if isinstance(v, (float, decimal.Decimal)):
        f = float(v)
        if math.isnan(f):
            return None
        if f.is_integer():
            return int(f)
        return round(f, digits)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x, digits) for x in v)
    return v


def rows_of(names, rows, digits=6):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_norm(r[i], digits) for i in order) for r in rows]
    return sorted(out, key=repr)


def compare(spark_df, con, sql: str, digits: int = 6):
    s_names = spark_df.columns
    s_rows = [tuple(r) for r in spark_df.collect()]
    res = con.execute(sql)
    d_names = [d[0] for d in res.description]
    d_rows = res.fetchall()
    problems = []
    if sorted(s_names) != sorted(d_names):
        problems.append(f"columns differ: spark={sorted(s_names)} duck={sorted(d_names)}")
        return problems
    if len(s_rows) != len(d_rows):
        problems.append(f"row count: spark={len(s_rows)} duck={len(d_rows)}")
    a = rows_of(s_names, s_rows, digits)
    b = rows_of(d_names, d_rows, digits)
    if a != b:
        diff = [(x, y) for x, y in zip(a, b) if x != y][:3]
        problems.append(f"values differ, e.g. {diff}")
    return problems
