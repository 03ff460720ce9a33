import math

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfmetrics.functions.labels import STOCK_STATUS, grade
from shelfmetrics.functions.metrics import (
    change_pct,
    exact_stddev,
    pct,
    round_half_away,
    safe_div,
    steady_avg,
)


def value(spark, column):
    return spark.range(1).select(column).first()[0]


@pytest.mark.parametrize(
    "x, places, expected",
    [(0.5, 0, 1.0), (-6.5, 0, -7.0), (2.675, 2, 2.68), (1.005, 2, 1.0), (0.0, 1, 0.0), (None, 1, None)],
)
def test_rounding(spark, x, places, expected):
    assert value(spark, round_half_away(F.lit(x).cast("double"), places)) == expected


@settings(max_examples=3, deadline=None)
@given(st.lists(st.floats(-1e9, 1e9), min_size=50, max_size=200))
def test_rounding_is_close_and_odd(spark, xs):
    df = spark.createDataFrame([(x,) for x in xs], "x double")
    for row in df.select("x", round_half_away("x", 1).alias("r"), round_half_away(-F.col("x"), 1).alias("m")).collect():
        assert math.isclose(row.r, row.x, abs_tol=0.0500001)
        assert row.m == -row.r


def test_division_by_zero_and_null(spark):
    assert value(spark, safe_div(F.lit(1), F.lit(0))) is None
    assert value(spark, safe_div(F.lit(None).cast("long"), F.lit(2))) is None
    assert value(spark, safe_div(F.lit(1), F.lit(8))) == 0.125


def test_percentages(spark):
    assert value(spark, pct(F.lit(1), F.lit(3))) == 33.3
    assert value(spark, change_pct(F.lit(12.5), F.lit(8.8))) == 42.0
    assert value(spark, change_pct(F.lit(5), F.lit(0))) is None


def test_null_falls_to_the_last_grade(spark):
    assert value(spark, grade(F.lit(None).cast("double"), STOCK_STATUS)) == STOCK_STATUS.otherwise
    assert STOCK_STATUS.labels == ("🔴 긴급", "🟡 주의", "🟢 양호", "⚪ 저회전")


def test_steady_mean_ignores_row_order(spark):
    rows = [0.1, 0.2, 0.3, 1e8, -1e8, 0.7, None] * 30
    means = {
        spark.createDataFrame([(x,) for x in order], "x double")
        .repartition(parts)
        .agg(steady_avg("x"))
        .first()[0]
        for order in (rows, rows[::-1], sorted(rows, key=lambda x: (x is None, x)))
        for parts in (1, 3, 7)
    }
    assert means == {1.3 / 6}
    assert spark.range(0).agg(steady_avg("id")).first()[0] is None


@pytest.mark.parametrize("x", [1e17, -1e17, 1e19, 9.3e16 + 16, math.inf, -math.inf])
def test_rounding_has_no_ceiling(spark, x):
    for places in (0, 2):
        assert value(spark, round_half_away(F.lit(x), places)) == x


def test_means_of_tiny_and_odd_values(spark):
    def mean(*values):
        return spark.createDataFrame([(float(v),) for v in values], "x double").agg(steady_avg("x")).first()[0]

    assert mean(1e-9, 3e-9) == 2e-9
    assert mean(1e-25, 3e-25) == pytest.approx(2e-25)
    assert math.isnan(mean(math.nan, 3))
    assert mean(math.inf, 3) == math.inf


def test_deviation_is_exact_in_any_order(spark):
    rows = [(k % 7,) for k in range(1000)]
    want = math.sqrt((1000 * sum(x * x for x, in rows) - sum(x for x, in rows) ** 2) / (1000 * 999))
    for parts in (1, 7, 16):
        df = spark.createDataFrame(rows, "x long").repartition(parts)
        assert df.agg(exact_stddev("x")).first()[0] == want
    assert spark.range(1).agg(exact_stddev("id")).first()[0] is None
