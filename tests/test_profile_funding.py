from datetime import date

from pyspark.sql import types as T

from rows import by, only
from shelfmetrics.operators.funding import reviewer_funding_costs
from shelfmetrics.operators.profile import table_profile
from shelfmetrics.sources.schemas import DOCUMENTED_TABLES


def test_funding_worked_example(spark):
    funding = spark.createDataFrame(
        [(date(2026, 1, 31), 1, 3), (date(2026, 1, 31), 2, 1)], "date date, sku_id long, quantity long"
    )
    price = spark.createDataFrame([(1, 1000)], "sku_id long, supply_price long")
    df = reviewer_funding_costs(funding, price)
    assert df.columns == DOCUMENTED_TABLES["cp_reviewer_funding"].names
    assert [t for _, t in df.dtypes] == ["date", *["bigint"] * 5]
    rows = by(df, "sku_id")
    assert tuple(rows[1])[2:] == (3, 375000, 3000, 378000)
    assert tuple(rows[2])[2:] == (1, 125000, None, None)


def test_required_nulls_are_violations(spark):
    declared = T.StructType(
        [T.StructField("id", T.LongType(), False), T.StructField("name", T.StringType())]
    )
    df = spark.createDataFrame([(1, None), (None, None)], "id long, name string")
    rows = by(table_profile(df, "t", declared), "column_name")
    assert tuple(rows["id"]) == ("t", 2, 2, "id", "INTEGER", "REQUIRED", 1, 1)
    assert tuple(rows["name"]) == ("t", 2, 2, "name", "STRING", "NULLABLE", 2, 0)


def test_empty_table(spark):
    df = spark.createDataFrame([], "a double")
    assert tuple(only(table_profile(df, "t"))) == ("t", 0, 1, "a", "FLOAT", "NULLABLE", 0, 0)


def test_nested_records_and_arrays(spark):
    inner = T.StructType(
        [T.StructField("q", T.LongType(), False), T.StructField("tags", T.ArrayType(T.StringType()))]
    )
    declared = T.StructType(
        [
            T.StructField("who", T.StructType([T.StructField("id", T.StringType(), False)])),
            T.StructField("lines", T.ArrayType(inner)),
        ]
    )
    loose = "who struct<id: string>, lines array<struct<q: long, tags: array<string>>>"
    df = spark.createDataFrame(
        [
            ((None,), [(1, ["a"]), (None, None)]),
            (None, None),
            (("x",), [(None, []), (4, [None])]),
        ],
        loose,
    )
    rows = by(table_profile(df, "t", declared), "column_name")
    got = {k: (r.type, r.mode, r.null_count, r.required_violations) for k, r in rows.items()}
    assert got == {
        "who": ("RECORD", "NULLABLE", 1, 0),
        "who.id": ("STRING", "REQUIRED", 1, 1),  # not the row without a record
        "lines": ("RECORD", "REPEATED", 1, 0),
        "lines.q": ("INTEGER", "REQUIRED", 2, 2),
        "lines.tags": ("STRING", "REPEATED", 1, 0),
    }


def test_every_documented_type_has_a_name(spark):
    for name, schema in DOCUMENTED_TABLES.items():
        df = spark.createDataFrame([], schema)
        kinds = {r.type for r in table_profile(df, name, schema).collect()}
        assert kinds <= {"STRING", "INTEGER", "FLOAT", "NUMERIC", "BOOLEAN", "DATE", "TIMESTAMP"}
