"""What the optimiser makes of the reports."""

import re

import pytest

import __spark_entry__ as registered
from conftest import TESTDATA
from rows import AS_OF, back, inventory, orders
from shelfmetrics.operators import inventory as stock_ops
from shelfmetrics.operators import product, sales

SF_DIR = f"{TESTDATA}/sf0.01"


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def formatted(df) -> str:
    explained = df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    return df._jdf.queryExecution().explainString(explained)


@pytest.fixture(scope="module")
def stored(spark, tmp_path_factory):
    """Order lines and stock as parquet tables, as a warehouse holds them."""
    path = str(tmp_path_factory.mktemp("stored"))
    orders(spark, {}, dict(order_date=back(3))).write.parquet(f"{path}/orders")
    inventory(spark, {}).write.parquet(f"{path}/inventory")
    return spark.read.parquet(f"{path}/orders"), spark.read.parquet(f"{path}/inventory")


def pushed(df) -> str:
    return " ".join(re.findall(r"PushedFilters: \[(.*?)\]\n", formatted(df)))


def test_day_filters_reach_the_scan(stored):
    lines, _ = stored
    for df in (
        sales.daily_sales_summary(lines, AS_OF),
        sales.weekly_trend(lines, AS_OF),
        sales.ytd_revenue_by_month(lines, 2026, AS_OF),
        sales.top_sellers(lines, AS_OF, AS_OF, 3),
        product.gpm_analysis(lines, AS_OF, AS_OF),
        stock_ops.daily_demand(lines, AS_OF, 30),
    ):
        filters = pushed(df)
        assert "GreaterThanOrEqual(order_date" in filters
        assert "LessThan(order_date" in filters


def test_month_filters_reach_the_scan_in_one_pass(stored):
    lines, _ = stored
    for df in (
        sales.monthly_comparison_detail(lines, "2026-03", 1),
        sales.monthly_comparison_summary(lines, "2026-03", 1, AS_OF),
    ):
        filters = pushed(df)
        assert "2026-03-01" in filters and "2025-03-01" in filters
        assert plan(df).count("FileScan") == 1


def test_only_needed_columns_are_read(stored):
    lines, stock = stored
    text = formatted(stock_ops.stock_status(stock, lines, AS_OF))
    schemas = re.findall(r"ReadSchema: struct<(.*?)>", text)
    assert "order_date:timestamp_ntz,sku:string,quantity:bigint" in schemas


def test_top_sellers_do_not_sort_everything(stored):
    lines, _ = stored
    assert "TakeOrderedAndProject" in plan(sales.top_sellers(lines, AS_OF, AS_OF, 3))


def test_shared_price_base_is_scanned_once(stored):
    lines, _ = stored
    base = product.product_prices(lines, AS_OF, AS_OF).persist()
    text = plan(product.price_competitiveness(lines, AS_OF, AS_OF, base))
    assert text.count("InMemoryTableScan") == 2
    base.unpersist()


@pytest.mark.parametrize("key", sorted(registered.report_queries()))
def test_no_cross_join_and_no_python(spark, key):
    text = plan(registered.report_queries()[key](spark, SF_DIR))
    for operator in ("CartesianProduct", "NestedLoop", "Python", "Pandas", "InArrow"):
        assert operator not in text, operator


def test_dead_cells_of_the_total_are_not_computed(stored):
    lines, _ = stored
    assert "Join" not in plan(sales.monthly_comparison_summary(lines, "2026-03", 1, AS_OF))


def test_hot_sku_is_split_at_run_time(spark):
    """With broadcasts off and low limits, the join of one hot key runs as a skew join."""
    from pyspark.sql import functions as F

    from shelfmetrics.functions.joins import join_stats

    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20KB",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "1.5",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "20KB",
        "spark.sql.shuffle.partitions": "40",
    }
    before = {key: spark.conf.get(key, None) for key in settings}
    try:
        for key, value in settings.items():
            spark.conf.set(key, value)
        n = 100_000
        sku = F.when(F.col("id") % 3 > 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 999))
        rows = spark.range(n).select(
            sku.alias("sku"), F.col("id").cast("string").alias("warehouse"), "id"
        ).repartition(8)
        stats = rows.groupBy("sku").agg(F.avg("id").alias("mean"))
        joined = join_stats(rows, stats, ["sku"], ["warehouse"], "left")
        assert joined.where("mean IS NOT NULL").count() == n
        joined.collect()
        assert "skew=true" in plan(joined)
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_order_count_combines_before_it_shuffles(spark):
    """A huge order must not stay in one task: its lines are combined, then moved by text id."""
    text = formatted(registered.queries()["weekly_trend"](spark, SF_DIR))
    moved = re.findall(r"Exchange\nInput.*\nArguments: hashpartitioning\((.*?)\), ENSURE", text)
    assert any("order_id" in keys for keys in moved), moved
