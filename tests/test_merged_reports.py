"""Reports over many days at once: one-pass bundles, stock of each day, quantile summaries, and
profiles of JSON columns."""

import random
from bisect import bisect_left, bisect_right
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as registered
from conftest import TESTDATA
from rows import AS_OF, back, by, inventory, orders
from shelfmetrics.functions.quantiles import quantiles, summaries
from shelfmetrics.operators import dashboard, inventory as ops
from shelfmetrics.operators.profile import document_profile, typed_documents
from shelfmetrics.plans import bases
from test_plans import plan

SF_DIR = f"{TESTDATA}/sf0.001"


@pytest.mark.parametrize(
    "report, facts",
    [
        ("_daily_report", ["lineitem"]), ("_inventory_report", ["lineitem"]),
        ("_monthly_report", ["lineitem"]), ("_ad_report", ["events", "events"]),
    ],
)
def test_a_bundle_scans_its_facts_once(spark, monkeypatch, report, facts):
    """Each base is one scan of its facts (campaigns and keywords are two tables here), and no tab
    reads them again; the month's ad tab reads its own."""
    read = []

    def written(df, name):
        read.extend(t for t in ("lineitem", "events") for _ in range(plan(df).count(f"{t}.parquet")))
        return real(df, name)

    real = bases.written
    monkeypatch.setattr(bases, "written", written)
    built = getattr(registered, report)(spark, SF_DIR, one_pass=True)
    assert read == facts
    for tab, df in built.tabs.items():
        again = [f for f in df.inputFiles() if "lineitem" in f or ("events" in f and tab != "ad_performance")]
        assert not again, tab


@pytest.mark.parametrize("name", ["daily_sales_report", "weekly_inventory_alert", "monthly_business_report", "ad_roas_report"])
def test_one_pass_gives_the_same_cells(spark, name):
    one, several = (registered.queries()[n](spark, SF_DIR) for n in (name, f"{name}_cells"))
    assert sorted(map(str, one.collect())) == sorted(map(str, several.collect()))


def test_stock_of_each_day_equals_that_many_reports(spark):
    rng = random.Random(8)
    lines = orders(spark, *[
        dict(sku=rng.choice("abc"), order_date=back(rng.randrange(0, 70)), quantity=rng.randrange(0, 9)) for _ in range(200)
    ], dict(sku="b", quantity=None))
    stock = inventory(spark, *[dict(sku=s, warehouse=w, current_stock=k * 7) for k, s in enumerate("abcd") for w in ("x", "y")])
    first = AS_OF - timedelta(days=29)
    got = ops.stock_status_daily(stock, lines, first, AS_OF).collect()
    want = [
        (day, *r)
        for day in (first + timedelta(days=k) for k in range(30))
        for r in ops.stock_rows(stock, lines, day).collect()
    ]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
    empty = ops.stock_status_daily(stock, lines.limit(0), AS_OF, AS_OF, 0)
    assert {r.days_of_stock for r in empty.collect()} == {None} and empty.count() == 8


@pytest.mark.parametrize("size", [1, 7, 50])
def test_quantile_summaries_keep_their_bound(spark, size):
    rng = random.Random(size)
    rows = [(rng.choice(["x", "y"]), d, rng.choice([round(rng.gauss(50, 20), 1), 50.0])) for d in range(6) for _ in range(rng.randrange(5, 400))]
    rows += [("x", 6, 1.5)] * 1500 + [("z", 1, None), ("w", 2, -3.0)]
    df = spark.createDataFrame(rows, "shelf string, day int, price double").repartition(5)
    stored = summaries(df, ["shelf", "day"], "price", size)
    assert stored.groupBy("shelf", "day").count().agg(F.max("count")).first()[0] <= size
    percentiles = list(range(101))
    for days in (range(7), [2], [1, 5]):
        got = quantiles(stored.where(F.col("day").isin(list(days))), ["shelf"], percentiles).collect()
        for shelf in "xyw":
            known = sorted(v for s, d, v in rows if s == shelf and d in days and v is not None)
            mine = [r for r in got if r.shelf == shelf]
            assert sorted(r.percentile for r in mine) == (percentiles if known else [])
            runs = [-(-sum(s == shelf and d == k and v is not None for s, d, v in rows) // size) for k in days]
            for r in mine:
                rank = max(1, -(-r.percentile * len(known) // 100))
                off = max(bisect_left(known, r.value) + 1 - rank, rank - bisect_right(known, r.value), 0)
                assert (r.n, r.bound) == (len(known), sum(runs)) and off <= r.bound
        assert not [r for r in got if r.shelf == "z"]


def test_large_summaries_are_exact_for_few_values(spark):
    df = spark.range(90).select(F.lit(1).alias("g"), F.col("id").cast("double").alias("v"))
    got = quantiles(summaries(df, ["g"], "v"), ["g"], [0, 50, 100]).collect()
    assert sorted((r.percentile, r.value, r.bound) for r in got) == [(0, 0.0, 1), (50, 44.0, 1), (100, 89.0, 1)]


def test_paths_inside_json_columns(spark):
    rows = [
        (1, '{"k": 1, "who": {"name": "a", "tags": ["x", null]}, "mixed": 1}'),
        (2, '{"k": null, "who": {"name": null}, "mixed": "text", "of d.ots": true}'),
        (3, '{"who": null, "price": 1.5}'), (4, "no json {"), (5, None),
    ]
    df = spark.createDataFrame(rows, "id long, props string")
    got = by(document_profile(df, "t", ["props"], ["id"]), "column_name")
    assert {n: (r.type, r.mode, r.null_count) for n, r in got.items()} == {
        "id": ("INTEGER", "REQUIRED", 0),
        "props": ("RECORD", "NULLABLE", 2),
        "props.k": ("INTEGER", "NULLABLE", 2),
        "props.mixed": ("JSON", "NULLABLE", 1),
        "props.of d.ots": ("BOOLEAN", "NULLABLE", 2),
        "props.price": ("NUMERIC", "NULLABLE", 2),
        "props.who": ("RECORD", "NULLABLE", 1),
        "props.who.name": ("STRING", "NULLABLE", 1),
        "props.who.tags": ("STRING", "REPEATED", 1),
    }
    assert {r.row_count for r in got.values()} == {5}
    assert typed_documents(df, ["props"]).where("id = 1").first().props.who.tags == ["x", None]
    nothing = by(document_profile(df.where("id > 3"), "t", ["props"]), "column_name")
    assert nothing["props"].null_count == 2


def test_printed_summary(spark):
    kpis = spark.createDataFrame([(k, f"item {k}", str(k)) for k in range(1, 7)], "position int, item string, value string")
    lines = [tuple(r)[1:] for r in dashboard.printed_summary(kpis, "2026-03", "now").collect()]
    assert lines[:5] == [("월간 비즈니스 리포트", "2026-03"), ("최종 업데이트", "now"), ("", None), ("항목", "값"), ("item 1", "1")]
    assert lines[7:13] == [("item 4", "4"), ("", None), ("재고 현황", None), ("item 5", "5"), ("item 6", "6"), ("", None)]
    assert len(lines) == 18 and lines[17] == ("광고성과", "캠페인별 ROAS 분석")
