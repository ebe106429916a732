"""Run a query on Spark and its SQL on DuckDB, and compare schema, row count and values."""

from __future__ import annotations

import glob
import hashlib
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def digest(columns: list[str], rows: list[tuple]) -> tuple[list[str], int, str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    lines = sorted(repr(tuple(row[i] for i in order)) for row in rows)
    return sorted(columns), len(rows), hashlib.sha256("\n".join(lines).encode()).hexdigest()


def spark_digest(df):
    return digest(df.columns, [tuple(r) for r in df.collect()])


def duck_digest(con, sql: str):
    relation = con.sql(sql)
    return digest(relation.columns, relation.fetchall())
