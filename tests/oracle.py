"""Compares a registered query with its SQL on DuckDB, regardless of row and column order."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(str(row[i]) for i in order) for row in rows])


def sql_rows(con, sql: str):
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    return sorted(columns), sorted_rows(columns, cursor.fetchall())


def spark_rows(df):
    return sorted(df.columns), sorted_rows(df.columns, df.collect())
