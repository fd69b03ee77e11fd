"""Comparing a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, list | tuple):
        return tuple(norm(x) for x in v)
    return round(v, 5) if isinstance(v, float) else v


def rows(found, columns: list[str]) -> list[tuple]:
    return sorted((tuple(norm(r[c]) for c in columns) for r in found), key=repr)


def assert_same(frame, con: duckdb.DuckDBPyConnection, sql: str) -> None:
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    expected = [dict(zip(names, r, strict=True)) for r in result.fetchall()]
    columns = sorted(frame.columns)
    assert sorted(names) == columns
    assert rows(frame.collect(), columns) == rows(expected, columns)
