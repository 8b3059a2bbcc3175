"""Compare a Spark result with a DuckDB result as multisets of rows."""

from __future__ import annotations

import glob
import os

import duckdb
from pyspark.sql import DataFrame

TYPES = {
    "int": "INTEGER", "bigint": "BIGINT", "string": "VARCHAR", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def rows_of(names: list[str], rows: list[tuple]) -> list[str]:
    """Rows as comparable text, with columns in name order."""
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(repr([row[i] for i in order]) for row in rows)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences, empty if there are none."""
    result = con.execute(sql)
    oracle_types = {d[0]: str(d[1]) for d in result.description}
    theirs = rows_of([d[0] for d in result.description], result.fetchall())
    spark_types = {n: TYPES.get(t, t) for n, t in df.dtypes}
    problems = []
    if spark_types != oracle_types:
        diff = {
            n: (spark_types.get(n), oracle_types.get(n))
            for n in {*spark_types, *oracle_types}
            if spark_types.get(n) != oracle_types.get(n)
        }
        problems.append(f"types differ (spark, oracle): {diff}")
    ours = rows_of(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        problems.append(f"rows: spark {len(ours)}, oracle {len(theirs)}")
    if ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b][:2]
        problems.append(f"values differ: {pairs}")
    return problems
