"""Compare a Spark result with the SQL result of an in-process DuckDB."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def sql_rows(sf_dir: str, sql: str) -> tuple[list[str], list[tuple]]:
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    cursor = con.execute(sql)
    return [d[0] for d in cursor.description], cursor.fetchall()


def _plain(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    if isinstance(value, int) or type(value).__name__ == "Decimal":
        return float(value)
    return str(value)


def normalised(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(spark, sf_dir: str, query, sql: str) -> str:
    """Empty when equal, else what differs."""
    frame = query(spark, sf_dir)
    columns, expected = sql_rows(sf_dir, sql)
    if sorted(columns) != sorted(frame.columns):
        return f"columns {sorted(frame.columns)} against {sorted(columns)}"
    ours = normalised(frame.columns, frame.collect())
    theirs = normalised(columns, expected)
    if len(ours) != len(theirs):
        return f"{len(ours)} rows against {len(theirs)}"
    wrong = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    return "" if not wrong else f"{len(wrong)} of {len(ours)} rows differ, first: {str(wrong[0])[:1500]}"
