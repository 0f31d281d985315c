"""Compare a registered query with its SQL check, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import glob
import os

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        table = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{path}')")
    return connection


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, dt.datetime):
        return value.isoformat(sep=" ")
    return value


def rows(columns, values) -> list[str]:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return sorted(repr([_plain(row[n]) for n in order]) for row in values)


KINDS = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "timestamp_ntz": "TIMESTAMP",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


def differences(df, connection, sql: str) -> list[str]:
    """What differs: columns, types, rows. Empty when the two agree."""
    described = connection.execute(f"DESCRIBE {sql}").fetchall()
    expected_types = {row[0]: row[1] for row in described}
    actual_types = {name: KINDS.get(kind, kind) for name, kind in df.dtypes}
    found = []
    if expected_types != actual_types:
        found.append(f"types: {sorted(set(expected_types.items()) ^ set(actual_types.items()))}")
        if set(expected_types) != set(actual_types):
            return found
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    expected = rows(names, result.fetchall())
    actual = rows(df.columns, [tuple(row) for row in df.collect()])
    if expected != actual:
        only_spark = sorted(set(actual) - set(expected))[:3]
        only_sql = sorted(set(expected) - set(actual))[:3]
        found.append(f"rows {len(actual)} vs {len(expected)}: spark {only_spark} sql {only_sql}")
    return found
