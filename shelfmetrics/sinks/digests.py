"""Digests of a table's content that do not depend on the order of its rows.

A digest can be taken while the rows are written, in the same pass, and again from the files.
"""

from __future__ import annotations

import hashlib

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def _sums(df: DataFrame) -> list[Column]:
    """Row count and two sums of row hashes. Rows count as often as they occur."""
    cells = [F.col(f"`{f.name}`").alias(f"c{k}") for k, f in enumerate(df.schema.fields)]
    # as JSON, since hashes of several columns pass over nulls
    row = F.to_json(F.struct(*cells), {"ignoreNullFields": "false"}) if cells else F.lit("")
    first, second = F.xxhash64(row), F.xxhash64(row, F.lit("second"))
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(first.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("first"),
        F.coalesce(F.sum(second.cast("decimal(20,0)")), F.lit(0)).cast("string").alias("second"),
    ]


def _named(rows: int, first: str, second: str) -> str:
    return hashlib.sha256(f"{rows} {first} {second}".encode()).hexdigest()


def watched(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df, and what becomes its count and digest once a write of it has ended."""
    seen = Observation("content")
    return df.observe(seen, *_sums(df)), seen


def observed(seen: Observation) -> tuple[int, str]:
    """(rows, digest) of a watched table that has been written."""
    got = seen.get
    return got["rows"], _named(got["rows"], got["first"], got["second"])


def content_digest(df: DataFrame) -> tuple[int, str]:
    """(rows, digest) of a table, in a pass of its own."""
    got = df.agg(*_sums(df)).first()
    return got["rows"], _named(got["rows"], got["first"], got["second"])
