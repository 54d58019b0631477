"""Comparing a query's rows with those of its SQL."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def _ordered(rows, names):
    order = sorted(range(len(names)), key=lambda i: names[i])
    shown = [tuple(repr(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(shown)


def spark_rows(df):
    return _ordered([tuple(row) for row in df.collect()], df.columns)


def sql_rows(connection, sql):
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    return _ordered(result.fetchall(), names)
