"""Run a query in Spark and its SQL in DuckDB, and compare all rows."""

from __future__ import annotations

import datetime as dt
import glob
import os

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, (dt.date, dt.datetime)):
        return str(value)
    return value


def _sorted(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    cells = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(cells, key=repr)


def compare(df, con, text: str) -> tuple[bool, str]:
    got_names, got = _sorted(df.columns, df.collect())
    result = con.execute(text)
    want_names, want = _sorted([d[0] for d in result.description], result.fetchall())
    if got_names != want_names:
        return False, f"columns {got_names} != {want_names}"
    if got != want:
        pairs = [(a, b) for a, b in zip(got, want) if a != b][:2]
        return False, f"{len(got)} rows, {len(want)} wanted; first differences {pairs}"
    kinds = {n: t for n, t in df.dtypes}
    return True, f"{len(got)} rows {sorted(kinds.items())} {[str(d[1]) for d in result.description]}"
