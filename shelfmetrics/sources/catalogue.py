"""Report tables in a catalogue, partitioned by day, and what may pass for one of them."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

_DAYS = (T.DateType, T.TimestampType, T.TimestampNTZType)


class SchemaMismatch(ValueError):
    """A table that cannot stand for the declared one."""


def _fits(have: T.DataType, wanted: T.DataType) -> bool:
    """Whether every value of one type has a counterpart in the other: numbers for numbers, days
    for days, anything atomic for text. Text is no number and no day."""
    if have == wanted:
        return True
    if isinstance(wanted, T.StringType):
        return isinstance(have, T.AtomicType) and not isinstance(have, T.BinaryType)
    if isinstance(wanted, T.NumericType):
        return isinstance(have, T.NumericType)
    return isinstance(have, _DAYS) and isinstance(wanted, _DAYS)


def schema_problems(have: T.StructType, wanted: T.StructType) -> list[str]:
    """What keeps a table from being read as the declared one; further columns do not."""
    kinds = {f.name: f.dataType for f in have.fields}
    out = []
    for field in wanted.fields:
        kind = kinds.get(field.name)
        if kind is None:
            out.append(f"{field.name} is missing")
        elif not _fits(kind, field.dataType):
            out.append(f"{field.name} is {kind.simpleString()}, not {field.dataType.simpleString()}")
    return out


def check_schema(df: DataFrame, wanted: T.StructType, name: str) -> DataFrame:
    """df, or an error that names everything that is wrong, before any row is read."""
    if problems := schema_problems(df.schema, wanted):
        raise SchemaMismatch(f"{name}: " + "; ".join(problems))
    return df


def save_by_day(df: DataFrame, dataset: str, table: str, day: str, path: str) -> None:
    """Save df as a catalogue table at ``path``, partitioned by the calendar day of ``day``.

    Rows are rebalanced by day first, so that a day is a few files of a fit size, and a day with
    most rows is split.
    """
    dated = df.withColumn(day, F.to_date(day)).hint("rebalance", F.col(day))
    dated.write.mode("overwrite").partitionBy(day).option("path", path).saveAsTable(f"{dataset}.{table}")


def new_dataset(spark: SparkSession, dataset: str, path: str) -> None:
    spark.sql(f"CREATE DATABASE IF NOT EXISTS `{dataset}` LOCATION '{path}'")


def on_days(df: DataFrame, column: str, days: DataFrame) -> DataFrame:
    """The rows of df on the days of another table, whose first column names them.

    Where df is partitioned by the column, the days are found first and only their partitions are
    read (run-time pruning), as long as ``days`` is a stored calendar filtered by a comparison.
    """
    return df.join(days.select(F.col(f"`{days.columns[0]}`").alias(column)).distinct(), column, "left_semi")
