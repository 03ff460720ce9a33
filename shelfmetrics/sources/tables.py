"""Readers: warehouse tables by name, columnar files, and sheet-backed text tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmetrics.sources.catalogue import check_schema
from shelfmetrics.sources.schemas import SCHEMAS

#: CSV as spreadsheets write it, with texts unaltered.
CSV_TEXT = {
    "escape": '"',
    "ignoreLeadingWhiteSpace": "false",
    "ignoreTrailingWhiteSpace": "false",
}

#: Stands for a quoted empty cell while a sheet is read.
_EMPTY = "\x00"

_DAY_TYPES = (T.DateType, T.TimestampType, T.TimestampNTZType)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the declared columns in the declared types.

    A column that already fits is passed through untouched, so filters on it still
    reach the scan. Any day type will do where a day type is declared: reports only
    use the calendar day.
    """
    have = {field.name: field.dataType for field in df.schema.fields}

    def column(field: T.StructField) -> Column:
        source, wanted = F.col(f"`{field.name}`"), field.dataType
        present = have.get(field.name)
        if present == wanted or (isinstance(wanted, _DAY_TYPES) and isinstance(present, _DAY_TYPES)):
            return source
        return source.cast(wanted).alias(field.name)

    return df.select(*[column(field) for field in schema.fields])


def read_table(
    spark: SparkSession, dataset: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """A catalog table ``dataset.table`` with its declared schema.

    A table that lacks a column, or has text where a number or a day is declared, is refused.
    """
    wanted, name = schema or SCHEMAS[table], f"{dataset}.{table}"
    return conform(check_schema(spark.table(name), wanted, name), wanted)


def read_files(
    spark: SparkSession, path: str, table: str, schema: T.StructType | None = None
) -> DataFrame:
    """The parquet files of one table at ``path``, with its declared schema."""
    return conform(spark.read.parquet(path), schema or SCHEMAS[table])


def read_sheet(spark: SparkSession, path: str, table: str, header: bool = True) -> DataFrame:
    """CSV export of a sheet-backed table: every column is text.

    Cells may hold quotes, line breaks and blanks; a row with too many or too few cells fails
    the read. An empty cell is NULL, a quoted one is empty. Sheets are small files, so that a
    file is read as a whole costs nothing; many files are read in parallel.
    """
    reader = spark.read.options(**CSV_TEXT).option("mode", "FAILFAST").option("emptyValue", _EMPTY)
    df = reader.csv(path, schema=SCHEMAS[table], header=header, multiLine=True)
    cells = [F.when(F.col(c) != _EMPTY, F.col(c)).when(F.col(c) == _EMPTY, "") for c in df.columns]
    return df.select(*[cell.alias(c) for cell, c in zip(cells, df.columns, strict=True)])


def as_number(column: str, kind: str = "bigint") -> Column:
    """A text column as a number, NULL where it is not one."""
    return F.trim(F.col(column)).try_cast(kind)
