import pytest

from rows import AS_OF, only, orders
from shelfmetrics.operators.sales import daily_sales_summary
from shelfmetrics.sinks.files import write_csv
from shelfmetrics.sources import tpch
from shelfmetrics.sources.schemas import DOCUMENTED_TABLES, REPORT_TABLES, SHEET_TABLES
from shelfmetrics.sources.tables import as_number, conform, read_files, read_sheet, read_table

COLUMNS = {
    "daily_performance": 36, "cp_products": 16, "rocket_metrics": 21, "cp_nca": 19,
    "cp_nca_ad": 10, "cp_pa": 34, "keyword_rankings": 18, "ca_brands": 11, "ca_products": 15,
    "ca_product_keywords": 12, "cp_coupon_funding": 5, "cp_reviewer_funding": 6,
    "ext_db_skuid": 2, "ext_ops_status": 20,
}


def test_documented_column_counts():
    assert {name: len(schema) for name, schema in DOCUMENTED_TABLES.items()} == COLUMNS


def test_required_columns():
    required = {n: [f.name for f in s if not f.nullable] for n, s in DOCUMENTED_TABLES.items()}
    assert {n: r for n, r in required.items() if r} == {
        "ca_brands": ["snapshot_date"],
        "ca_product_keywords": ["snapshot_date"],
        "ca_products": ["snapshot_date"],
        "cp_nca_ad": ["date"],
        "cp_reviewer_funding": ["date", "sku_id"],
    }


def test_attribution_columns_come_in_their_documented_order():
    names = DOCUMENTED_TABLES["cp_pa"].names
    assert names[14:17] == ["total_orders_1d", "direct_orders_1d", "indirect_orders_1d"]
    assert names[29:32] == [f"{p}_conv_revenue_14d" for p in ("total", "direct", "indirect")]


def test_catalog_tables_are_read_in_declared_types(spark):
    spark.sql("CREATE DATABASE IF NOT EXISTS shop")
    raw = spark.sql(
        "SELECT 7 AS order_id, DATE '2026-03-20' AS order_date, 'web' AS channel, 'case' AS category,"
        " 'p' AS product_id, 'n' AS product_name, 's' AS sku, 2 AS quantity, 10.00000005D AS revenue,"
        " 4.0D AS cost, 5.0D AS unit_price, 2.0D AS unit_cost, 'ignored' AS extra"
    )
    raw.write.mode("overwrite").saveAsTable("shop.orders")
    df = read_table(spark, "shop", "orders")
    assert df.columns == REPORT_TABLES["orders"].names
    kinds = dict(df.dtypes)
    assert (kinds["order_id"], kinds["order_date"], kinds["revenue"]) == ("string", "date", "decimal(28,8)")
    row = only(daily_sales_summary(df, AS_OF))
    assert (row.total_revenue, row.total_qty) == (10.00000005, 2)


def test_parquet_files_and_missing_columns(spark, tmp_path):
    orders(spark, {}).write.parquet(f"{tmp_path}/orders")
    assert read_files(spark, f"{tmp_path}/orders", "orders").count() == 1
    with pytest.raises(Exception, match="(?i)unresolved|cannot be resolved"):
        conform(spark.range(1), REPORT_TABLES["orders"])


def test_sheet_tables_are_all_text(spark, tmp_path):
    assert set(SHEET_TABLES) <= set(DOCUMENTED_TABLES)
    (tmp_path / "sheet.csv").write_text("sku_id,sku_name\n001, case \n12x,film\n")
    df = read_sheet(spark, f"{tmp_path}/sheet.csv", "ext_db_skuid")
    assert df.dtypes == [("sku_id", "string"), ("sku_name", "string")]
    assert [tuple(r) for r in df.select("sku_id", as_number("sku_id")).collect()] == [
        ("001", 1),
        ("12x", None),
    ]


def test_sheets_keep_every_text(spark, tmp_path):
    cells = ['6" film, clear', "two\nlines", "  blanks  ", "", None, "plain", 'q"', ","]
    schema = DOCUMENTED_TABLES["ext_db_skuid"]
    df = spark.createDataFrame([(str(k), c) for k, c in enumerate(cells)], schema)
    assert write_csv(df, f"{tmp_path}/sheet") == len(cells)
    back = read_sheet(spark, f"{tmp_path}/sheet", "ext_db_skuid")
    assert sorted(map(tuple, back.collect())) == sorted(map(tuple, df.collect()))


def test_malformed_sheet_rows_are_not_swallowed(spark, tmp_path):
    (tmp_path / "sheet.csv").write_text("sku_id,sku_name\n1,a,surplus\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        read_sheet(spark, f"{tmp_path}/sheet.csv", "ext_db_skuid").collect()


def test_views_without_a_dimension_keep_every_line(spark):
    sf_dir = "/root/testdata/sf0.001"
    full = tpch.order_lines(spark, sf_dir)
    assert {"channel", "category", "sku", "cost"} <= set(full.columns)
    lean = tpch.order_lines(spark, sf_dir, customers=False, parts=False)
    assert lean.count() == full.count() == tpch.table(spark, sf_dir, "lineitem").count()
    assert not {"channel", "sku"} & set(lean.columns)


def test_session_keeps_submitted_tuning(spark):
    from shelfmetrics.session import TUNING, get_session

    key = "spark.sql.adaptive.autoBroadcastJoinThreshold"
    assert spark.conf.get(key) == TUNING[key]
    assert get_session().conf.get("spark.sql.session.timeZone") == "UTC"
