"""Compare registered queries with their SQL twins in DuckDB."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _text(value) -> str:
    if value is None or value is pd.NaT or (isinstance(value, float) and value != value):
        return "∅"
    if isinstance(value, pd.Timestamp):
        return value.strftime("%Y-%m-%d %H:%M:%S.%f")
    if hasattr(value, "isoformat"):
        return pd.Timestamp(value).strftime("%Y-%m-%d %H:%M:%S.%f")
    if isinstance(value, (bool,)) or type(value).__name__ == "bool_":
        return str(bool(value))
    if isinstance(value, (int, float)) or hasattr(value, "dtype"):
        number = float(value)
        return repr(0.0 if number == 0 else number)
    return str(value)


def rows_of(columns: list[str], records) -> list[tuple[str, ...]]:
    at = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_text(record[i]) for i in at) for record in records)


def compare(df, con: duckdb.DuckDBPyConnection, sql: str) -> str:
    """Empty if both sides agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    theirs = rows_of(names, result.fetchall())
    ours = rows_of(df.columns, df.collect())
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs) if a != b]
    return f"{len(wrong)} of {len(ours)} rows differ, first {wrong[0]}" if wrong else ""
