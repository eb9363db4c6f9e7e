"""Side-by-side run of the registered queries and their SQL."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[:-len(".parquet")]
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _sortable(row: tuple) -> tuple:
    return tuple((value is None, str(value)) for value in row)


def rows(columns: list[str], data: list[tuple]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(r[i] for i in order) for r in data), key=_sortable)


def same(a, b) -> bool:
    if isinstance(a, float) and isinstance(b, float):
        return a == b or math.isclose(a, b, rel_tol=1e-12)
    return a == b and type(a) is type(b)


def difference(name: str, ours: list[tuple], theirs: list[tuple]) -> str | None:
    if len(ours) != len(theirs):
        return f"{name}: {len(ours)} rows, expected {len(theirs)}"
    for left, right in zip(ours, theirs):
        if not all(same(a, b) for a, b in zip(left, right)):
            return f"{name}: {left} is not {right}"
    return None
