"""Run a registered query and its SQL on the same tables and compare all values."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb
from pyspark.sql import DataFrame


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        c.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return c


def difference(df: DataFrame, sql: str, c: duckdb.DuckDBPyConnection) -> str | None:
    """None if both sides have the same columns and rows, types of values included."""
    found = c.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(names) != sorted(df.columns):
        return f"columns differ: {sorted(set(names) ^ set(df.columns))}"
    order = sorted(names)
    want = Counter(tuple(r[names.index(n)] for n in order) for r in found.fetchall())
    got = Counter(tuple(r[n] for n in order) for r in df.collect())
    if want.total() != got.total():
        return f"rows differ: spark {got.total()}, sql {want.total()}"
    only_spark, only_sql = got - want, want - got
    if only_spark:
        a, b = sorted(only_spark, key=str)[0], sorted(only_sql, key=str)[0]
        diff = [(n, x, y) for n, x, y in zip(order, a, b) if x != y]
        return f"{only_spark.total()} of {got.total()} rows differ, e.g. {a[:3]} {b[:3]} {diff[:6]}"
    bad = {n for n, *pair in zip(order, *[_types(side) for side in (got, want)]) if pair[0] != pair[1]}
    return f"types differ in {bad}" if bad else None


def _types(rows: Counter) -> list[set[str]]:
    if not rows:
        return []
    return [{type(v).__name__ for v in column if v is not None} for column in zip(*rows)]
