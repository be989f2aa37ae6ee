"""Spark and DuckDB results side by side, compared as multisets inside DuckDB."""

from __future__ import annotations

import duckdb

TABLES = ("nation", "customer", "orders", "lineitem", "events")

# Spark and DuckDB names of the same type.
TYPE_NAMES = {
    "string": "VARCHAR", "date": "DATE", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP", "decimal(38,2)": "DECIMAL(38,2)",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return connection


def assert_same(frame, connection, sql: str) -> int:
    """Same columns, types and rows (with their counts); returns how many rows."""
    kinds = {name: TYPE_NAMES[kind] for name, kind in frame.dtypes}
    expected = connection.execute(f"DESCRIBE {sql}").fetchall()
    assert kinds == {name: kind for name, kind, *_ in expected}
    names = ", ".join(sorted(kinds))
    connection.register("spark_result", frame.toArrow())
    connection.execute(f"CREATE OR REPLACE TEMP TABLE ours AS SELECT {names} FROM spark_result")
    connection.execute(f"CREATE OR REPLACE TEMP TABLE theirs AS SELECT {names} FROM ({sql})")
    extra = connection.execute("SELECT * FROM ours EXCEPT ALL SELECT * FROM theirs LIMIT 5").fetchall()
    missing = connection.execute("SELECT * FROM theirs EXCEPT ALL SELECT * FROM ours LIMIT 5").fetchall()
    assert (extra, missing) == ([], []), names
    return connection.execute("SELECT count(*) FROM ours").fetchall()[0][0]
