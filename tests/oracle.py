"""Compare a registered query with its SQL on the same parquet tables."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(round(value, 6))
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(con, df, sql: str) -> str | None:
    """None if equal, else what differs."""
    result = con.execute(sql)
    want_columns, want = _rows([d[0] for d in result.description], result.fetchall())
    got_columns, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; {[r for r in got if r not in set(want)][:2]} / {[r for r in want if r not in set(got)][:2]}"
    wrong = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(wrong)} rows differ, e.g. {wrong[0]}" if wrong else None
