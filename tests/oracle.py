"""Comparison of a Spark result with DuckDB on the same files."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    connection = duckdb.connect()
    for path in sorted(glob.glob(f"{sf_dir}/*.parquet")):
        name = os.path.splitext(os.path.basename(path))[0]
        connection.execute(f"create view {name} as select * from read_parquet('{path}')")
    return connection


def rows_of_sql(connection, sql: str) -> tuple[list[str], Counter]:
    cursor = connection.execute(sql)
    names = [column[0] for column in cursor.description]
    return _sorted_columns(names, cursor.fetchall())


def rows_of_spark(df) -> tuple[list[str], Counter]:
    return _sorted_columns(df.columns, [tuple(row) for row in df.collect()])


def _sorted_columns(names, rows):
    order = sorted(range(len(names)), key=names.__getitem__)
    return [names[i] for i in order], Counter(tuple(row[i] for i in order) for row in rows)
