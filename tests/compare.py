"""Comparison of a Spark query with its SQL on the same tables."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if hasattr(value, "as_tuple"):
        return float(value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def difference(df, con, sql: str) -> str | None:
    """What differs between a DataFrame and a SQL result; None if nothing does."""
    names, got = _rows(df.columns, [tuple(r) for r in df.collect()])
    result = con.execute(sql)
    wanted_names, wanted = _rows([d[0] for d in result.description], result.fetchall())
    if names != wanted_names:
        return f"columns {names} != {wanted_names}"
    if len(got) != len(wanted):
        return f"{len(got)} rows != {len(wanted)}"
    bad = [(a, b) for a, b in zip(got, wanted) if repr(a) != repr(b)]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None
