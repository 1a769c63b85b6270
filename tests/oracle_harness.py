"""Compare a registered Spark query with its DuckDB oracle the way the driver
does: row count, column names, order-insensitive hash of the values."""

from __future__ import annotations

import datetime as dt
import decimal
import hashlib
import math

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 6)
    if isinstance(v, decimal.Decimal):
        return round(float(v), 6)
    if isinstance(v, (dt.datetime, dt.date)):
        return v.isoformat()
    if isinstance(v, (list, tuple)):
        return tuple(_norm(x) for x in v)
    if isinstance(v, dict):
        return tuple(sorted((k, _norm(x)) for k, x in v.items()))
    return v


def digest(columns: list[str], rows: list[tuple]) -> tuple[int, list[str], str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(_norm(r[i]) for i in order)) for r in rows)
    h = hashlib.sha256("\n".join(lines).encode()).hexdigest()
    return len(rows), sorted(columns), h


def compare(spark, sf_dir: str, name: str, query, sql: str, con=None) -> dict:
    df = query(spark, sf_dir)
    s_rows = [tuple(r) for r in df.collect()]
    s = digest(df.columns, s_rows)
    con = con or duck(sf_dir)
    res = con.execute(sql)
    cols = [d[0] for d in res.description]
    d_rows = res.fetchall()
    o = digest(cols, d_rows)
    out = {"name": name, "rows": s[0], "oracle_rows": o[0], "schema": s[1] == o[1], "hash": s[2] == o[2]}
    if not (out["schema"] and out["hash"] and s[0] == o[0]):
        out["spark_cols"], out["oracle_cols"] = s[1], o[1]
        sset = {repr(tuple(_norm(x) for x in r)) for r in s_rows}
        oi = [cols.index(c) for c in df.columns] if sorted(cols) == sorted(df.columns) else None
        if oi:
            oset = {repr(tuple(_norm(r[i]) for i in oi)) for r in d_rows}
            out["only_spark"] = sorted(sset - oset)[:3]
            out["only_oracle"] = sorted(oset - sset)[:3]
    return out
