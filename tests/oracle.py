"""Compare a query with its DuckDB SQL on the same tables, without regard to row order."""

from __future__ import annotations

import os

import duckdb


def _plain(value):
    if isinstance(value, float):
        return round(value, 6)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return value


def compare(df, sql: str, sf_dir: str) -> None:
    db = duckdb.connect()
    for name in os.listdir(sf_dir):
        db.execute(f"create view {name.removesuffix('.parquet')} as select * from '{sf_dir}/{name}'")
    columns = sorted(df.columns)
    got = sorted((tuple(_plain(row[c]) for c in columns) for row in df.collect()), key=repr)
    found = db.sql(sql)
    assert sorted(found.columns) == columns
    names = ", ".join(f'"{c}"' for c in columns)
    want = sorted((tuple(_plain(v) for v in row) for row in db.sql(f"select {names} from ({sql})").fetchall()), key=repr)
    assert len(got) == len(want)
    assert got == want
