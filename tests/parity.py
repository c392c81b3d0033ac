"""Runs a query in Spark and its oracle in DuckDB and compares the values."""

from __future__ import annotations

import datetime
import math
from pathlib import Path

import duckdb


def oracle_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for f in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM read_parquet('{f}')")
    return con


def _plain(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    if isinstance(v, datetime.datetime):
        return v.isoformat()
    return repr(v)


def normalise(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def spark_rows(df):
    return sorted(df.columns), normalise(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql: str):
    cur = con.execute(sql)
    columns = [d[0] for d in cur.description]
    return sorted(columns), normalise(columns, cur.fetchall())
