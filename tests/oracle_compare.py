"""Run a registered query and its SQL side by side and compare the rows exactly."""

from __future__ import annotations

import datetime as dt
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark "
    "labels conversations"
).split()


def open_duckdb(folder: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{folder}/{table}.parquet')")
    return connection


def _cell(value):
    if isinstance(value, float) and math.isnan(value):
        return (1, "nan")
    if value is None:
        return (0, "")
    if isinstance(value, (dt.datetime, dt.date)):
        return (1, value.isoformat())
    if isinstance(value, bool):
        return (1, str(value))
    if isinstance(value, (int, float)):
        return (1, type(value).__name__ + repr(value))
    return (1, str(value))


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda index: columns[index])
    return sorted(tuple(_cell(row[index]) for index in order) for row in rows)


def differences(spark_df, connection, sql: str) -> str | None:
    """``None`` when equal, else a short report."""
    left_columns = spark_df.columns
    left = rows_of(left_columns, spark_df.collect())
    cursor = connection.execute(sql)
    right_columns = [column[0] for column in cursor.description]
    right = rows_of(right_columns, cursor.fetchall())
    if sorted(left_columns) != sorted(right_columns):
        return f"columns {sorted(left_columns)} != {sorted(right_columns)}"
    if len(left) != len(right):
        return f"{len(left)} rows != {len(right)} rows"
    for a, b in zip(left, right):
        if a != b:
            return f"{a}\n != \n{b}"
    return None
