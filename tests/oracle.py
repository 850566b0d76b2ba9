"""Run a query on Spark and its SQL on DuckDB, and compare the two results as bags of rows."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return f"{type(value).__name__}:{value}"


def _bag(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(spark_df, con, sql: str) -> str | None:
    """None when equal, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    expected_rows = cursor.fetchall()
    if sorted(names) != sorted(spark_df.columns):
        return f"columns: spark-only {set(spark_df.columns) - set(names)}, sql-only {set(names) - set(spark_df.columns)}"
    actual = _bag(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    expected = _bag(names, expected_rows)
    if actual == expected:
        return None
    extra, lacking = list((actual - expected).items())[:2], list((expected - actual).items())[:2]
    return (
        f"{sorted(names)}\n rows {sum(actual.values())} vs {sum(expected.values())};"
        f"\n spark-only {extra}\n sql-only {lacking}"
    )
