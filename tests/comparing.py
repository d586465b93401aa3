"""Compare a Spark query with DuckDB's answer to its SQL."""

from __future__ import annotations

import os

import duckdb

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path + '/*.parquet' if os.path.isdir(path) else path}')")
    return con


def _cell(x: object) -> str:
    if x is None or x != x:
        return "NULL"
    return f"{float(x):.9g}" if isinstance(x, (int, float)) and not isinstance(x, bool) else str(x)


def rows_of(rows: list, columns: list[str], order: list[str]) -> list[tuple]:
    at = [columns.index(c) for c in order]
    return sorted(tuple(_cell(r[k]) for k in at) for r in rows)


def assert_same(df, con, sql: str) -> None:
    found = con.execute(sql)
    theirs = [d[0] for d in found.description]
    assert sorted(df.columns) == sorted(theirs)
    order = sorted(theirs)
    assert rows_of([tuple(r) for r in df.collect()], df.columns, order) == rows_of(found.fetchall(), theirs, order)
