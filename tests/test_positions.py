"""Row numbers by range cuts against plain Python."""

import random
import re

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA
from oracle_check import compare, duck
from shelfmetrics.functions.positions import with_position
from test_plans import plan

SF_DIR = f"{TESTDATA}/sf0.01"


@pytest.mark.parametrize("ranges", [4, 16])
@pytest.mark.parametrize("key", ["stock_status_ranked", "reorder_alert_ranked", "price_competitiveness_ranked"])
def test_reports_in_their_order(spark, key, ranges):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    try:
        spark.conf.set("spark.sql.shuffle.partitions", ranges)
        df = registered.queries()[key](spark, SF_DIR)
        assert compare(df, duck(SF_DIR), registered.oracle_sql()[key]) > 0
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


@pytest.mark.parametrize("ranges", [1, 4, 16])
def test_groups_nulls_and_ties(spark, ranges):
    rng = random.Random(ranges)
    rows = [(rng.choice(["a", "b", None]), rng.choice([None, 1, 2, 3]), k, "x") for k in range(500)]
    rows += [("hot", 1, 1000, "x")] * 700  # equal in everything
    df = spark.createDataFrame(rows, "g string, v int, k long, position0 string").repartition(6)
    got = with_position(df, [F.desc("v"), F.col("k")], ["g"], total="n", ranges=ranges).collect()
    assert len(got) == len(rows)
    for g in ("a", "b", None, "hot"):
        own = [r for r in rows if r[0] == g]
        want = sorted(own, key=lambda r: (r[1] is None, -(r[1] or 0), r[2]))
        mine = sorted((r for r in got if r.g == g), key=lambda r: r.position)
        assert [r.position for r in mine] == list(range(1, len(own) + 1))
        assert [(r.g, r.v, r.k, r.position0) for r in mine] == want
        assert {r.n for r in mine} == {len(own)}


def test_a_value_that_all_rows_share_is_split(spark):
    df = spark.range(40_000).select(F.lit(1).alias("v"))
    numbered = with_position(df, [F.col("v")], ranges=16)
    assert numbered.agg(F.count_distinct("position"), F.min("position"), F.max("position")).first() == (40_000, 1, 40_000)
    part = spark.read.parquet(re.search(r"ranges-[0-9a-f]+", plan(numbered)) and _scanned(numbered))
    held = part.groupBy(next(c for c in part.columns if c.startswith("_part"))).count().collect()
    assert len(held) > 8 and max(r["count"] for r in held) < 10_000


def _scanned(df) -> str:
    return df.inputFiles()[0].rsplit("/", 1)[0]


def test_no_window_over_one_partition(spark):
    for groups in ([], ["g"]):
        df = spark.range(100).select("id", (F.col("id") % 3).alias("g"))
        text = plan(with_position(df, [F.col("id")], groups))
        assert "SinglePartition" not in text
    assert with_position(spark.range(0), [F.col("id")]).count() == 0
    assert with_position(spark.range(0).withColumn("g", F.lit(1)), [F.col("id")], ["g"]).count() == 0
