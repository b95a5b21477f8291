"""Run registered queries and their SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in Path(sf_dir).glob("*.parquet"):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    out = [tuple(_cell(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(out, key=lambda row: [(v is not None, str(type(v)), v) for v in row])


def spark_rows(df):
    return rows_of(df.columns, df.collect())


def sql_rows(con, sql):
    result = con.execute(sql)
    names = [column[0] for column in result.description]
    return rows_of(names, result.fetchall())


def difference(got, want) -> str:
    """Empty when equal, else a short account."""
    if got[0] != want[0]:
        return f"columns {got[0]} != {want[0]}"
    if len(got[1]) != len(want[1]):
        return f"{len(got[1])} rows != {len(want[1])}"
    wrong = [(a, b) for a, b in zip(got[1], want[1]) if a != b]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else ""
