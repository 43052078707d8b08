"""Run a registered query and its SQL and compare the results cell by cell."""

from __future__ import annotations

import glob
import math
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _clean(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def compare(spark, con, make, sql: str, sf_dir: str) -> list[str]:
    """What differs, as messages."""
    df = make(spark, sf_dir)
    rel = con.sql(sql)
    mine, theirs = df.columns, rel.columns
    if sorted(mine) != sorted(theirs):
        return [f"columns {sorted(mine)} vs {sorted(theirs)}"]
    order = sorted(mine)
    kinds = {"bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "int": "INTEGER"}
    types = dict(df.dtypes)
    other_types = dict(zip(rel.columns, [str(t) for t in rel.types]))
    problems = [f"type of {c}: {types[c]} vs {other_types[c]}" for c in order
                if kinds.get(types[c]) != other_types[c]]
    left = sorted((tuple(_clean(r[c]) for c in order) for r in df.select(*order).collect()), key=repr)
    picks = [theirs.index(c) for c in order]
    right = sorted((tuple(_clean(r[p]) for p in picks) for r in rel.fetchall()), key=repr)
    if len(left) != len(right):
        problems.append(f"rows {len(left)} vs {len(right)}")
    elif left != right:
        bad = next((a, b) for a, b in zip(left, right) if a != b)
        problems.append(f"values differ, first {bad[0]} vs {bad[1]}")
    return problems
