"""Compare a Spark result with the SQL twin in DuckDB, as sorted rows of plain values."""

from __future__ import annotations

import os

import duckdb

DATA = "/root/testdata"


def duck(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone='UTC'")
    folder = f"{DATA}/{sf}"
    for name in os.listdir(folder):
        con.execute(f"CREATE VIEW {name.removesuffix('.parquet')} AS FROM '{folder}/{name}'")
    return con


def rows_of(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    return sorted(df.columns), rows_of(df.columns, df.collect())


def duck_rows(con, sql: str) -> tuple[list[str], list[tuple]]:
    result = con.execute(sql)
    columns = [c[0] for c in result.description]
    return sorted(columns), rows_of(columns, result.fetchall())
