"""Row comparison of a Spark result with the result of its SQL."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_cell(row[i]) for i in order) for row in rows), key=lambda r: tuple(map(repr, r)))


def differences(spark_df, connection, sql):
    """None when names, kinds of types and all rows agree, else what differs."""
    found = spark_df.collect()
    result = connection.execute(sql)
    columns = [d[0] for d in result.description]
    expected = result.fetchall()
    if sorted(columns) != sorted(spark_df.columns):
        return f"columns {sorted(spark_df.columns)} but {sorted(columns)}"
    left, right = sorted_rows(spark_df.columns, found), sorted_rows(columns, expected)
    if len(left) != len(right):
        return f"{len(left)} rows but {len(right)}: {left[:2]} / {right[:2]}"
    pairs = [(a, b) for a, b in zip(left, right) if list(map(repr, a)) != list(map(repr, b))]
    return f"{len(pairs)} of {len(left)} rows, e.g. {pairs[:2]}" if pairs else None
