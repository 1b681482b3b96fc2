"""Runs a query and its SQL side by side and reports the first difference."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def plain(value):
    if value is None:
        return None
    if isinstance(value, bool):
        return value
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.replace(tzinfo=None)
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def _sortable(row):
    return tuple((v is not None, type(v).__name__, repr(v)) for v in row)


def spark_rows(df):
    names = sorted(df.columns)
    rows = [tuple(plain(r[n]) for n in names) for r in df.select(*[f"`{n}`" for n in names]).collect()]
    return names, sorted(rows, key=_sortable)


def sql_rows(con, sql):
    cur = con.execute(sql)
    have = [d[0] for d in cur.description]
    names = sorted(have)
    order = [have.index(n) for n in names]
    rows = [tuple(plain(r[i]) for i in order) for r in cur.fetchall()]
    return names, sorted(rows, key=_sortable)


def difference(df, con, sql):
    """None, or what differs."""
    a_names, a = spark_rows(df)
    b_names, b = sql_rows(con, sql)
    if a_names != b_names:
        return f"columns {a_names} against {b_names}"
    if len(a) != len(b):
        return f"{len(a)} rows against {len(b)}; first: {str(a[:1])[:300]} / {str(b[:1])[:300]}"
    for x, y in zip(a, b):
        if x != y or [type(v) for v in x] != [type(v) for v in y]:
            cells = [(n, p, q) for n, p, q in zip(a_names, x, y) if p != q or type(p) is not type(q)]
            return f"row differs in {str(cells)[:900]}"
    return None
