"""Table profile: the schema page of a table, with its REQUIRED columns checked."""

from __future__ import annotations

import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Warehouse names of the Spark types.
_TYPE_NAMES = {
    T.StringType: "STRING",
    T.IntegerType: "INTEGER",
    T.LongType: "INTEGER",
    T.FloatType: "FLOAT",
    T.DoubleType: "FLOAT",
    T.DecimalType: "NUMERIC",
    T.BooleanType: "BOOLEAN",
    T.DateType: "DATE",
    T.TimestampNTZType: "DATETIME",
    T.TimestampType: "TIMESTAMP",
    T.BinaryType: "BYTES",
    T.StructType: "RECORD",
    T.VariantType: "JSON",
}


class _Field(NamedTuple):
    path: str
    type_name: str
    mode: str
    nulls: Column


def _fields(
    schema: T.StructType, parent: Column | None = None, in_array: bool = False, prefix: str = ""
) -> Iterator[_Field]:
    """Every field, depth first, with a per-row count of its missing values.

    Below a repeated record the value is the array of the field over all elements.
    A field of a missing record is not missing itself.
    """
    for field in schema.fields:
        name, kind = field.name, field.dataType
        value = F.col(f"`{name}`") if parent is None else parent.getField(name)

        if in_array:
            nulls = F.size(F.filter(value, lambda x: x.isNull()))
            nulls = F.when(parent.isNull(), 0).otherwise(nulls)
        else:
            here = value.isNull() if parent is None else parent.isNotNull() & value.isNull()
            nulls = here.cast("int")

        repeated = isinstance(kind, T.ArrayType)
        if repeated:
            kind = kind.elementType
            if in_array:
                value = F.flatten(F.filter(value, lambda x: x.isNotNull()))
        mode = "REPEATED" if repeated else "NULLABLE" if field.nullable else "REQUIRED"
        yield _Field(
            prefix + name, _TYPE_NAMES.get(type(kind), kind.simpleString().upper()), mode, nulls
        )
        if isinstance(kind, T.StructType):
            yield from _fields(kind, value, in_array or repeated, f"{prefix}{name}.")


def table_profile(df: DataFrame, table: str, schema: T.StructType | None = None) -> DataFrame:
    """One row per field: type, mode, NULL count and REQUIRED violations.

    ``schema`` is the declared schema (its nullability says what is REQUIRED).
    All counts come from one pass with map-side combining.
    """
    schema = schema or df.schema
    fields = list(_fields(schema))
    counts = df.agg(
        F.count(F.lit(1)).alias("row_count"),
        *[F.coalesce(F.sum(f.nulls), F.lit(0)).alias(f"nulls_{i}") for i, f in enumerate(fields)],
    )
    lines = [
        F.struct(
            F.lit(f.path).alias("column_name"),
            F.lit(f.type_name).alias("type"),
            F.lit(f.mode).alias("mode"),
            F.col(f"nulls_{i}").alias("null_count"),
            (F.col(f"nulls_{i}") if f.mode == "REQUIRED" else F.lit(0).cast("bigint")).alias(
                "required_violations"
            ),
        )
        for i, f in enumerate(fields)
    ]
    return counts.select(
        F.lit(table).alias("table_name"),
        "row_count",
        F.lit(len(schema.fields)).cast("bigint").alias("column_count"),
        F.inline(F.array(*lines)),
    )


def typed_documents(df: DataFrame, columns: list[str]) -> DataFrame:
    """df with JSON text columns as records of the fields that are found in them.

    One pass merges the schemas of all values; what is of different kinds in different rows stays
    JSON, what is null everywhere is text. A text that is no JSON is missing. The schema has a
    field for each distinct path, so columns are meant that hold records, not maps with keys from
    the data.
    """
    parsed = df.withColumns({c: F.try_parse_json(F.col(f"`{c}`")) for c in columns})
    found = parsed.agg(*[F.schema_of_variant_agg(F.col(f"`{c}`")).alias(c) for c in columns]).first()
    kinds = {c: _record_type(found[c]) for c in columns}
    return parsed.withColumns({
        c: F.col(f"`{c}`") if kind == "VARIANT" else F.try_variant_get(F.col(f"`{c}`"), "$", kind)
        for c, kind in kinds.items()
    })


def _record_type(found: str) -> str:
    """The type a variant schema stands for."""
    words = re.split(r"(`(?:[^`]|``)*`|\w+)", found)
    return "".join({"OBJECT": "STRUCT", "VOID": "STRING"}.get(w, w) for w in words)


def document_profile(
    df: DataFrame, table: str, columns: list[str], required: Iterable[str] = ()
) -> DataFrame:
    """The table's profile with the paths inside its JSON columns as dotted rows.

    ``required`` names REQUIRED columns of the table.
    """
    typed, required = typed_documents(df, columns), set(required)
    declared = [T.StructField(f.name, f.dataType, f.name not in required) for f in typed.schema]
    return table_profile(typed, table, T.StructType(declared))
