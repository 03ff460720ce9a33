"""Compare a Spark result with a DuckDB result: names, types, rows and values."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()

_KINDS = {
    "bigint": "int", "int": "int", "integer": "int", "tinyint": "int", "smallint": "int",
    "double": "double", "float": "double", "string": "text", "varchar": "text",
    "boolean": "boolean", "date": "date", "timestamp": "timestamp", "timestamp_ntz": "timestamp",
}


def duck(sf_dir: str):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(
            f"CREATE VIEW {table} AS SELECT * FROM read_parquet('{sf_dir}/{table}.parquet')"
        )
    return connection


def _cell(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value + 0.0:.17g}"
    return "NULL" if value is None else str(value)


def _table(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(df, connection, sql: str) -> int:
    """Assert equality; returns the row count."""
    result = connection.execute(sql)
    oracle_names = [c[0] for c in result.description]
    oracle_kinds = {c[0]: str(c[1]).lower() for c in result.description}
    oracle_rows = result.fetchall()
    assert sorted(df.columns) == sorted(oracle_names)
    for name, kind in df.dtypes:
        assert _KINDS[kind] == _KINDS[oracle_kinds[name]], (name, kind, oracle_kinds[name])
    rows = [tuple(r) for r in df.collect()]
    ours, theirs = _table(df.columns, rows), _table(oracle_names, oracle_rows)
    assert len(ours) == len(theirs)
    different = [(a, b) for a, b in zip(ours, theirs, strict=True) if a != b]
    assert not different, different[:3]
    return len(ours)
