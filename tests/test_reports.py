import csv
import glob
import json

import pytest

import __spark_entry__ as registered
from conftest import TESTDATA
from rows import AS_OF, ad_campaigns, ad_keywords, back, by, inventory, only, orders
from shelfmetrics import __main__ as cli
from shelfmetrics.operators import dashboard
from shelfmetrics.plans import bundles
from shelfmetrics.sinks import files

# Output columns in the order the reports print them.
COLUMNS = {
    "daily_sales_summary": "sale_date channel category order_count total_qty total_revenue "
    "total_cost gross_profit gpm_pct",
    "weekly_trend": "week_start channel orders revenue profit gpm_pct wow_change_pct",
    "monthly_comparison_detail": "channel category cur_orders cur_revenue cur_profit cur_gpm_pct "
    "yoy_orders yoy_revenue yoy_profit yoy_gpm_pct revenue_yoy_pct orders_yoy_pct profit_yoy_pct "
    "target_contribution_pct",
    "monthly_comparison_summary": "channel category cur_orders cur_revenue cur_profit cur_gpm_pct "
    "yoy_orders yoy_revenue yoy_profit yoy_gpm_pct revenue_yoy_pct orders_yoy_pct profit_yoy_pct "
    "target_achievement_pct ytd_revenue",
    "top_sellers": "product_id product_name sku total_qty total_revenue order_count avg_price gpm_pct",
    "stock_status": "sku product_name warehouse current_stock avg_daily_sales days_of_stock status",
    "depletion_forecast": "sku product_name warehouse current_stock ma_7d ma_14d ma_30d "
    "depletion_days_7d depletion_days_14d depletion_days_30d estimated_depletion_date trend_pct "
    "weekly_acceleration demand_cv_pct forecast_status trend_direction",
    "reorder_alert": "sku product_name warehouse current_stock avg_daily_sales sales_stddev "
    "lead_time_days lead_time_demand safety_stock reorder_point days_of_stock order_quantity "
    "days_until_reorder alert_level",
    "rocket_delivery_risk": "sku product_name rocket_stock avg_daily_sales peak_daily_sales "
    "days_remaining sales_acceleration_pct risk_level",
    "roas_by_campaign": "campaign_id campaign_name platform impressions clicks ctr_pct total_spend "
    "attributed_revenue roas orders cpa efficiency",
    "ad_spend_efficiency": "report_date platform daily_spend impressions clicks orders cpc cpm cpa "
    "ctr_pct cvr_pct roas cpc_change_pct spend_efficiency",
    "keyword_performance": "keyword match_type campaign_name platform impressions clicks ctr_pct "
    "keyword_spend cpc conversions cvr_pct revenue roas cpa keyword_grade conversion_quality",
    "gpm_analysis": "sku product_name category channel total_qty revenue cogs gross_profit gpm_pct "
    "avg_selling_price avg_unit_cost gpm_tier",
    "price_competitiveness": "sku product_name category channel avg_selling_price "
    "category_avg_price price_index price_percentile total_qty revenue margin_pct price_tier "
    "competitiveness_label pct_of_max_price category_sku_count",
}


@pytest.mark.parametrize("key", sorted(COLUMNS))
def test_output_columns(spark, key):
    df = registered.queries()[key](spark, f"{TESTDATA}/sf0.001")
    assert df.columns == COLUMNS[key].split()
    assert not [t for _, t in df.dtypes if t.startswith("decimal")]


def lines_of(path):
    parts = sorted(glob.glob(f"{path}/part-*.csv"))
    return [row for part in parts for row in csv.reader(open(part, encoding="utf-8"))]


def test_json_export_keeps_nulls_and_every_row(spark, tmp_path):
    df = spark.createDataFrame([(1, None), (2, "b"), (3, "c")], "a long, b string")
    files.write_json(df, f"{tmp_path}/all")
    parts = sorted(glob.glob(f"{tmp_path}/all/part-*.json"))
    rows = [json.loads(line) for p in parts for line in open(p, encoding="utf-8")]
    assert {"a": 1, "b": None} in rows and len(rows) == 3
    files.write_json(df.orderBy("a"), f"{tmp_path}/sorted")
    assert sorted(r.a for r in spark.read.json(f"{tmp_path}/sorted").collect()) == [1, 2, 3]


def test_csv_export_counts_and_round_trips(spark, tmp_path):
    df = spark.createDataFrame([(1, 'say "hi", ok'), (2, None)], "a long, b string")
    assert files.write_csv(df, f"{tmp_path}/t") == 2
    back_again = spark.read.csv(f"{tmp_path}/t", header=True, escape='"', schema="a long, b string")
    assert sorted(map(tuple, back_again.collect())) == sorted(map(tuple, df.collect()))
    assert files.write_csv(spark.range(50), f"{tmp_path}/all") == 50


def test_empty_exports_are_counted_too(spark, tmp_path):
    nothing = spark.range(9).where("id > 100").groupBy("id").count()
    assert files.write_csv(nothing.orderBy("id"), f"{tmp_path}/sorted") == 0
    assert files.write_tab(nothing, f"{tmp_path}/tab", ["a", "b"]) == 0


def test_sheet_values_are_plain_text(spark):
    df = spark.createDataFrame(
        [(1, 12500000.0, 43.123456789012, -0.5, None), (2, 1e-9, 1e25, 100.0, "x")],
        "a long, b double, c double, d double, e string",
    )
    got = files.sheet_values(df)
    assert {t for _, t in got.dtypes} == {"string"}
    assert [tuple(r) for r in got.collect()] == [
        ("1", "12500000", "43.123456789012", "-0.5", "null"),
        ("2", "0.000000001", "1.0E25", "100", "x"),
    ]
    assert files.sheet_values(df, list("VWXYZ")).columns == list("VWXYZ")
    with pytest.raises(ValueError):
        files.sheet_values(df, ["one"])


def test_dashboard_without_sales(spark):
    summary = spark.createDataFrame(
        [(None, None, None)],
        "cur_revenue double, revenue_yoy_pct double, target_achievement_pct double",
    )
    counts = spark.createDataFrame([(3, 4)], "critical_count long, warning_count long")
    rows = dashboard.monthly_kpi_dashboard(summary, counts, 500_000_000).orderBy("position").collect()
    assert [r["value"] for r in rows] == ["0", "N/A%", "N/A%", "500000000", "3", "4"]
    assert rows[0]["item"] == "당월 매출"


def test_dashboard_with_sales(spark):
    summary = spark.createDataFrame(
        [(250000000.0, 13.6, 50.0)],
        "cur_revenue double, revenue_yoy_pct double, target_achievement_pct double",
    )
    counts = spark.createDataFrame([(0, 0)], "critical_count long, warning_count long")
    values = [r["value"] for r in dashboard.monthly_kpi_dashboard(summary, counts, 5e8).collect()]
    assert values[:4] == ["250000000.00", "13.6%", "50.0%", "500000000"]


def test_monthly_report_is_written_tab_by_tab(spark, tmp_path):
    df = orders(spark, dict(order_date=back(1), quantity=10), dict(order_date=back(365)))
    with bundles.monthly_business_report(
        df, inventory(spark, {}), ad_campaigns(spark, {}), "2026-03", AS_OF, 1000
    ) as report:
        assert list(report.tabs) == [
            "summary", "monthly_sales", "monthly_total", "top_sellers", "stock_status",
            "ad_performance",
        ]
        rows = files.write_report(report, str(tmp_path), "2026-03-20 09:00:00")
        assert all(shared.is_cached for shared in report.shared)
        counted = {r.tab: r.row_count for r in bundles.tab_row_counts(report).collect()}
    assert not any(shared.is_cached for shared in report.shared)
    assert rows == counted
    assert rows == dict(
        summary=6, monthly_sales=1, monthly_total=1, top_sellers=1, stock_status=1, ad_performance=1
    )
    summary = lines_of(f"{tmp_path}/summary")
    assert summary[0] == ["항목", "값"]
    assert ["목표 달성률", "10.0%"] in summary
    assert lines_of(f"{tmp_path}/monthly_sales")[0] == bundles.HEADER_MONTH
    total = lines_of(f"{tmp_path}/monthly_total")
    assert total[0][:3] == ["** TOTAL **", "** ALL **", "1"]  # no header row
    stamp = spark.read.csv(f"{tmp_path}/stamp", header=True).collect()
    assert {r.tab: r.title for r in stamp} == report.titles
    assert {r.generated_at for r in stamp} == {"2026-03-20 09:00:00"}
    assert {r.period for r in stamp} == {"2026-03-01 ~ 2026-03-31"}


def test_daily_report(spark):
    df = orders(spark, *[dict(product_id=f"p{i}") for i in range(12)])
    report = bundles.daily_sales_report(df, "2026-03-20")
    assert (report.period, report.tabs["top_sellers"].count()) == ("2026-03-20", 10)


def test_inventory_alert(spark):
    df = orders(spark, dict(order_date=back(1), quantity=50, channel="coupang_rocket"))
    stock = inventory(spark, dict(warehouse="coupang_rocket", current_stock=50))
    with bundles.weekly_inventory_alert(stock, df, AS_OF) as report:
        assert tuple(only(report.tabs["summary"])) == (1, 0, 1, 2)
        assert set(by(report.tabs["urgent_skus"], "source")) == {"재고", "로켓"}


def test_ad_report_defaults_to_a_week_before_the_end(spark):
    campaigns = ad_campaigns(
        spark, {}, dict(campaign_id="poor", report_date=back(7), attributed_revenue=1.0),
        dict(campaign_id="old", report_date=back(8)),
    )
    keywords = ad_keywords(spark, {}, dict(keyword="stop", attributed_revenue=1.0))
    with bundles.ad_roas_report(campaigns, keywords, AS_OF) as report:
        assert report.period == "2026-03-13 ~ 2026-03-20"
        assert set(by(report.tabs["campaigns"], "campaign_id")) == {"c1", "poor"}
        assert only(report.tabs["deficit_campaigns"]).campaign_id == "poor"
        assert only(report.tabs["stop_review_keywords"]).keyword == "stop"
        assert report.tabs["weekly_trend"].count() == 2  # 28 days, so the older rows too
        row = only(report.tabs["summary"])
        assert (row.campaign_count, row.deficit_count, row.stop_keyword_count) == (2, 1, 1)


def test_report_titles_and_headers_cover_the_tabs(spark):
    df, stock = orders(spark, {}), inventory(spark, {})
    ads, words = ad_campaigns(spark, {}), ad_keywords(spark, {})
    for report in (
        bundles.daily_sales_report(df, AS_OF),
        bundles.weekly_inventory_alert(stock, df, AS_OF),
        bundles.monthly_business_report(df, stock, ads, "2026-03", AS_OF),
        bundles.ad_roas_report(ads, words, AS_OF),
    ):
        with report:
            assert set(report.titles) == set(report.tabs)
            for tab, header in report.headers.items():
                assert len(header) == len(report.tabs[tab].columns)


def test_command_line_runs_each_report(spark, tmp_path):
    tables = {
        "orders": orders(spark, {}),
        "inventory": inventory(spark, {}),
        "ad_campaigns": ad_campaigns(spark, {}),
        "ad_keywords": ad_keywords(spark, {}),
    }
    for report in ("daily", "inventory", "monthly", "ads"):
        args = cli.parse(
            [report, "--dataset", "d", "--out", f"{tmp_path}/{report}", "--as-of", "2026-03-20"]
        )
        with cli.build(args, tables.__getitem__) as built:
            assert built.tabs
    assert built.period == "2026-03-13 ~ 2026-03-20"


@pytest.mark.parametrize(
    "name, tabs",
    [
        ("daily_sales_report", 2),
        ("weekly_inventory_alert", 2),
        ("monthly_business_report", 6),
        ("ad_roas_report", 7),
    ],
)
def test_bundle_queries_hand_out_every_cell(spark, name, tabs):
    cells = registered.queries()[name](spark, f"{TESTDATA}/sf0.01").collect()
    width = {}
    for c in cells:
        width.setdefault(c.tab, set()).add(c.header)
        assert c.text is None or c.number is None
    assert len(width) == tabs  # the month's ad tab, too, has rows in its own month
