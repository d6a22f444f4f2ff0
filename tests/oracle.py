"""Run a registered query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from pathlib import Path

import duckdb


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def plain(value):
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return None if math.isnan(value) else value + 0.0
    if isinstance(value, dt.datetime):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return [plain(v) for v in value]
    return value


def normal_rows(columns: list[str], rows) -> tuple[list[str], list[list]]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    out = [[plain(r[i]) for i in order] for r in rows]
    return [columns[i] for i in order], sorted(out, key=lambda r: [(v is None, str(type(v)) * 0, repr(v)) for v in r])


def compare(df, sql: str, con: duckdb.DuckDBPyConnection) -> str | None:
    """None when both sides give the same rows, else what differs first."""
    got_columns, got = normal_rows(df.columns, [tuple(r) for r in df.collect()])
    answer = con.execute(sql)
    want_columns, want = normal_rows([c[0] for c in answer.description], answer.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} != {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}; first {got[:2]} / {want[:2]}"
    for g, w in zip(got, want):
        if g != w and [repr(x) for x in g] != [repr(x) for x in w]:
            return f"{g} != {w}"
    return None
