"""Spark and DuckDB results side by side, without regard to row order."""

from __future__ import annotations

import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# Spark types and the DuckDB types that hold the same values.
SAME_TYPE = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS FROM '{sf_dir}/{table}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    return None if value is None else str(value)


def _sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(
        (tuple(_plain(row[i]) for i in order) for row in rows),
        key=lambda row: tuple((value is not None, value or "") for value in row),
    )


def differences(found, connection: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between a Spark frame and the rows of a query; empty if nothing does."""
    cursor = connection.execute(sql)
    kinds = {d[0]: str(d[1]) for d in cursor.description}
    wanted = cursor.fetchall()
    if sorted(found.columns) != sorted(kinds):
        return [f"columns {sorted(found.columns)} but {sorted(kinds)}"]
    notes = []
    types = {name: SAME_TYPE.get(kind, kind) for name, kind in found.dtypes}
    notes += [f"{c}: {types[c]} but {kinds[c]}" for c in kinds if types[c] != kinds[c]]
    if not wanted:
        notes.append("no rows to compare")
    ours, theirs = _sorted_rows(found.columns, found.collect()), _sorted_rows(list(kinds), wanted)
    if len(ours) != len(theirs):
        notes.append(f"{len(ours)} rows but {len(theirs)}")
    elif ours != theirs:
        first = next(pair for pair in zip(ours, theirs) if pair[0] != pair[1])
        notes.append(f"first different row: {first[0]} but {first[1]}")
    return notes
