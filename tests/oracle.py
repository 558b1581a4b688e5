"""Run a registered query and its SQL twin and compare the rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

DATA = Path("/root/testdata")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("set timezone = 'UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def differences(df, con, sql: str) -> list[str]:
    """Empty when both sides have the same columns, types and rows."""
    table = con.sql(sql).to_arrow_table()
    rows = df.toArrow()
    problems = []
    if sorted(rows.column_names) != sorted(table.column_names):
        return [f"columns {sorted(rows.column_names)} != {sorted(table.column_names)}"]
    names = sorted(rows.column_names)
    for n in names:
        mine, theirs = str(rows.schema.field(n).type), str(table.schema.field(n).type)
        if mine.replace("large_", "") != theirs.replace("large_", ""):
            problems.append(f"type of {n}: {mine} != {theirs}")

    def bag(t):
        columns = [t.column(n).to_pylist() for n in names]
        return Counter(tuple(_plain(v) for v in row) for row in zip(*columns))

    left, right = bag(rows), bag(table)
    if left != right:
        problems.append(
            f"{sum(left.values())} vs {sum(right.values())} rows; "
            f"only here: {list((left - right).items())[:3]}; "
            f"only in the oracle: {list((right - left).items())[:3]}"
        )
    return problems
