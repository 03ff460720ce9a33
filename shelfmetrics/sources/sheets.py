"""Sheets that may be broken: rows that keep to the declared schema, and all others with a reason.

A sheet is a small CSV file that people edit. A file is parsed as a whole by one task, which knows
the line a row begins in; many files are parsed in parallel. Types are checked by Spark.
"""

from __future__ import annotations

import csv
import io
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmetrics.scratch import written

#: Rows handed on at a time.
_ROWS = 5_000
_PARSED = "file string, line long, cells array<string>, raw string, header array<string>"
#: What takes the place of bytes that are not UTF-8.
_UNREADABLE = "�"


@dataclass
class Sheet:
    """``rows`` have the declared columns and types; ``rejected`` has file, line, reason and the
    text of every other row. Together they are all rows of the files."""

    rows: DataFrame
    rejected: DataFrame


def records(content: bytes) -> Iterator[tuple[int, list[str | None], str]]:
    """(line, cells, text) of the rows of a CSV file; blank lines are none. An empty cell is None,
    a quoted one is empty. A quote that is never closed takes all that follows into its row."""
    text = content.decode("utf-8-sig", errors="replace")
    taken: list[str] = []

    def lines() -> Iterator[str]:
        for line in io.StringIO(text, newline=""):
            taken.append(line)
            yield line

    csv.field_size_limit(1 << 30)
    begin = 1
    # unquoted empty cells are told from quoted ones by the text, since readers differ there
    for cells in csv.reader(lines()):
        raw = "".join(taken)
        if cells:
            yield begin, _with_nulls(cells, raw), raw.rstrip("\r\n")
        begin += len(taken)
        taken.clear()


def _with_nulls(cells: list[str], raw: str) -> list[str | None]:
    if "" not in cells:
        return cells
    out: list[str | None] = []
    at = 0
    for cell in cells:
        quoted = raw[at : at + 1] == '"'
        out.append(cell if cell or quoted else None)
        # behind the cell and its separator
        at += len(cell) + (2 + cell.count('"') if quoted else 0) + 1
    return out


def _parse(header: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = [pa.string(), pa.int64(), pa.list_(pa.string()), pa.string(), pa.list_(pa.string())]
        names = ["file", "line", "cells", "raw", "header"]

        def batch(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else [()] * len(names)
            return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds, strict=True)], names)

        for given in batches:
            for path, content in zip(given.column("path"), given.column("content"), strict=True):
                rows, top = [], None
                for line, cells, raw in records(content.as_py()):
                    if header and top is None:
                        top = [c or "" for c in cells]
                        continue
                    rows.append((path.as_py(), line, cells, raw, top))
                    if len(rows) == _ROWS:
                        yield batch(rows)
                        rows = []
                yield batch(rows)

    return run


def _reasons(schema: T.StructType, header: bool) -> list[Column]:
    """Each is a text where a row breaks the schema, else NULL; the first that is set counts."""
    names, found = schema.names, F.size("cells")
    reasons = []
    if header:
        same = F.col("header") == F.array(*[F.lit(n) for n in names])
        reasons.append(F.when(~same, F.lit("the header is not the declared one")))
    reasons.append(F.when(F.contains("raw", F.lit(_UNREADABLE)), F.lit("not UTF-8")))
    reasons.append(F.when(found < len(names), F.lit("too few cells")).when(found > len(names), F.lit("too many cells")))
    for k, field in enumerate(schema.fields):
        cell = F.get("cells", F.lit(k))
        if not field.nullable:
            reasons.append(F.when(cell.isNull(), F.lit(f"{field.name}: missing")))
        if not isinstance(field.dataType, T.StringType):
            wrong = cell.isNotNull() & _typed(cell, field.dataType).isNull()
            reasons.append(F.when(wrong, F.lit(f"{field.name}: not a {field.dataType.simpleString()}")))
    return reasons


def _typed(cell: Column, kind: T.DataType) -> Column:
    return cell if isinstance(kind, T.StringType) else F.trim(cell).try_cast(kind)


def read_sheet_rows(spark: SparkSession, path: str, schema: T.StructType, header: bool = True) -> Sheet:
    """All rows of the sheets at ``path``: those that keep to the schema, typed, and the others.

    A row is rejected for the first of these: its file's header is not the declared one, it holds
    bytes that are not UTF-8, it has too few or too many cells, a REQUIRED cell is empty, a cell
    cannot be read as the declared type. Nothing fails the read. Empty files have no rows.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "content")
    parsed = files.mapInArrow(_parse(header), _PARSED)
    parsed = written(parsed.withColumn("reason", F.coalesce(*_reasons(schema, header))), "sheet-rows")
    columns = [_typed(F.get("cells", F.lit(k)), f.dataType).alias(f.name) for k, f in enumerate(schema.fields)]
    return Sheet(
        rows=parsed.where(F.col("reason").isNull()).select(*columns),
        rejected=parsed.where(F.col("reason").isNotNull()).select("file", "line", "reason", "raw"),
    )
