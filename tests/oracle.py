"""Runs registered queries on Spark and their SQL on DuckDB and compares the rows."""

from __future__ import annotations

import math

import duckdb

from airgauge.registry import TABLES


def duck(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{directory}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, bool):
        return str(v)
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v if v != int(v) else int(v)) if abs(v) < 1e15 else repr(v)
    return "" if v is None else str(v)


def rows(columns: list[str], data) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(r[i]) for i in order) for r in data)


def difference(df, con, sql: str) -> str | None:
    """None when both engines give the same rows; else what differs."""
    cur = con.execute(sql)
    want_cols = [x[0] for x in cur.description]
    want = rows(want_cols, cur.fetchall())
    if sorted(df.columns) != sorted(want_cols):
        return f"columns {sorted(df.columns)} != {sorted(want_cols)}"
    table = df.toArrow()
    got = rows(df.columns, list(zip(*[table.column(i).to_pylist() for i in range(table.num_columns)])))
    if got == want:
        return None
    only_got = [x for x in got if x not in set(want)][:3]
    only_want = [x for x in want if x not in set(got)][:3]
    return f"{len(got)} rows against {len(want)}; only Spark {only_got}; only SQL {only_want}"
