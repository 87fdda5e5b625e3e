"""Compare a query with its SQL: same columns, same rows, any order."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, float) and math.isfinite(value):
        return repr(round(value, 9))
    return repr(value)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> str | None:
    result = con.execute(sql)
    sql_columns = [field[0] for field in result.description]
    sql_types = {field[0]: str(field[1]) for field in result.description}
    if sorted(df.columns) != sorted(sql_columns):
        return f"columns {sorted(df.columns)} vs {sorted(sql_columns)}"
    spark_types = {name: kind for name, kind in df.dtypes}
    names = {"bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE", "boolean": "BOOLEAN", "int": "INTEGER"}
    off = {n: (spark_types[n], sql_types[n]) for n in df.columns if names.get(spark_types[n]) != sql_types[n]}
    got, want = _rows(df.columns, df.collect()), _rows(sql_columns, result.fetchall())
    if not want:
        return "no rows"
    if got != want:
        first = next((pair for pair in zip(got, want) if pair[0] != pair[1]), None)
        return f"{len(got)} vs {len(want)} rows, first difference {str(first)[:600]}"
    return f"types {off}" if off else None
