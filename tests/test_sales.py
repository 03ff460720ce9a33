from datetime import date, datetime

import pytest

from rows import AS_OF, back, by, only, orders
from shelfmetrics.operators import sales

MONTH, TARGET = "2026-03", 1000


def in_march(day, year=2026, hour=12):
    return datetime(year, 3, day, hour)


def test_daily_summary_counts_orders_once_and_keeps_margin_unrounded(spark):
    df = orders(
        spark,
        dict(order_id="a", revenue=100.0, cost=60.0, quantity=2),
        dict(order_id="a", revenue=50.0, cost=40.0, quantity=1),
        dict(order_id="b", order_date=back(1)),
    )
    row = only(sales.daily_sales_summary(df, AS_OF))
    assert (row.sale_date, row.order_count, row.total_qty) == (AS_OF, 1, 3)
    assert (row.total_revenue, row.total_cost, row.gross_profit) == (150.0, 100.0, 50.0)
    assert row.gpm_pct == pytest.approx(100 / 3, abs=1e-9)


def test_daily_summary_covers_the_whole_day_only(spark):
    df = orders(
        spark,
        dict(order_id="first", order_date=datetime(2026, 3, 20)),
        dict(order_id="last", order_date=datetime(2026, 3, 20, 23, 59, 59)),
        dict(order_id="next", order_date=datetime(2026, 3, 21)),
    )
    assert only(sales.daily_sales_summary(df, "2026-03-20")).order_count == 2


def test_daily_summary_zero_revenue_has_no_margin(spark):
    assert only(sales.daily_sales_summary(orders(spark, dict(revenue=0.0)), AS_OF)).gpm_pct is None


def test_daily_summary_order(spark):
    df = orders(
        spark,
        dict(channel="b", revenue=5.0),
        dict(channel="a", revenue=5.0),
        dict(channel="c", revenue=9.0),
    )
    assert [r.channel for r in sales.daily_sales_summary(df, AS_OF).collect()] == ["c", "a", "b"]


def test_weekly_trend_compares_with_the_previous_week_that_has_sales(spark):
    df = orders(
        spark,
        dict(order_date=datetime(2026, 3, 2), revenue=100.0),  # Monday
        dict(order_date=datetime(2026, 3, 8, 23), revenue=100.0),  # Sunday of the same week
        dict(order_date=datetime(2026, 3, 16), revenue=150.0),  # two weeks on
    )
    weeks = by(sales.weekly_trend(df, AS_OF), "week_start")
    assert set(weeks) == {date(2026, 3, 2), date(2026, 3, 16)}
    assert weeks[date(2026, 3, 2)].wow_change_pct is None
    assert weeks[date(2026, 3, 16)].wow_change_pct == -25.0


def test_weekly_trend_window(spark):
    df = orders(spark, dict(order_date=back(84)), dict(order_date=back(85)), dict(order_date=back(-1)))
    assert only(sales.weekly_trend(df, AS_OF)).revenue == 100.0


def test_monthly_detail_one_sided_cells(spark):
    df = orders(
        spark,
        dict(channel="new", order_date=in_march(5), revenue=100.0, cost=60.0),
        dict(channel="old", order_date=in_march(5, 2025), revenue=80.0, cost=20.0),
    )
    cells = by(sales.monthly_comparison_detail(df, MONTH, TARGET), "channel")
    new, old = cells["new"], cells["old"]
    assert (new.cur_orders, new.cur_revenue, new.cur_profit, new.cur_gpm_pct) == (1, 100, 40, 40.0)
    assert (new.yoy_orders, new.yoy_revenue, new.yoy_profit, new.yoy_gpm_pct) == (0, 0, 0, 0)
    assert new.revenue_yoy_pct is new.orders_yoy_pct is new.profit_yoy_pct is None
    assert new.target_contribution_pct == 10.0
    assert (old.cur_revenue, old.yoy_revenue, old.yoy_gpm_pct) == (0, 80, 75.0)
    assert old.revenue_yoy_pct is old.target_contribution_pct is None


def test_monthly_detail_null_keys_do_not_pair(spark):
    df = orders(
        spark,
        dict(channel=None, order_date=in_march(1), revenue=10.0),
        dict(channel=None, order_date=in_march(1, 2025), revenue=20.0),
        dict(category=None, order_date=in_march(1), revenue=30.0),
        dict(category=None, order_date=in_march(1, 2025), revenue=40.0),
    )
    got = sales.monthly_comparison_detail(df, MONTH, TARGET).collect()
    assert sorted((r.cur_revenue, r.yoy_revenue) for r in got) == [(0, 20), (0, 40), (10, 0), (30, 0)]


def test_monthly_changes_follow_the_worked_example(spark):
    df = orders(
        spark,
        dict(order_date=in_march(31, hour=23), revenue=48_000_000.0),
        dict(order_date=in_march(1, 2025, hour=0), revenue=42_000_000.0),
        dict(order_date=datetime(2026, 4, 1), revenue=1.0),
        dict(order_date=datetime(2026, 2, 28, 23), revenue=1.0),
    )
    row = only(sales.monthly_comparison_detail(df, MONTH, 500_000_000))
    assert (row.revenue_yoy_pct, row.target_contribution_pct) == (14.3, 9.6)


def test_monthly_summary_adds_up_cells_and_year_to_date(spark):
    df = orders(
        spark,
        dict(order_id="x", category="case", order_date=in_march(2), revenue=100.0),
        dict(order_id="x", category="film", order_date=in_march(2), revenue=50.0),
        dict(order_id="x", category="film", order_date=in_march(3), revenue=50.0),
        dict(order_id="y", order_date=in_march(2, 2025), revenue=100.0),
        dict(order_id="z", order_date=datetime(2026, 1, 1), revenue=7.0),
        dict(order_id="z", order_date=datetime(2025, 12, 31), revenue=9.0),
        dict(order_id="z", order_date=datetime(2026, 3, 21), revenue=11.0),  # after as_of
    )
    row = only(sales.monthly_comparison_summary(df, MONTH, TARGET, AS_OF))
    assert (row.channel, row.category) == ("** TOTAL **", "** ALL **")
    assert (row.cur_orders, row.yoy_orders) == (3, 1)  # x in two cells, z after as_of
    assert row.cur_revenue == 211.0
    assert row.ytd_revenue == 207.0
    assert row.target_achievement_pct == 21.1


def test_year_to_date_covers_the_year_not_the_month(spark):
    df = orders(spark, dict(order_date=datetime(2026, 3, 1), revenue=5.0))
    row = only(sales.monthly_comparison_summary(df, "2026-01", TARGET, AS_OF))
    assert (row.cur_revenue, row.ytd_revenue, row.target_achievement_pct) == (None, 5.0, None)


def test_summary_of_nothing_is_one_row_of_nulls(spark):
    row = only(sales.monthly_comparison_summary(orders(spark), MONTH, TARGET, AS_OF))
    assert (row.cur_orders, row.cur_revenue, row.ytd_revenue) == (None, None, None)


def test_ytd_by_month_is_not_running(spark):
    df = orders(
        spark,
        dict(order_date=datetime(2026, 1, 5), revenue=1.0),
        dict(order_date=datetime(2026, 2, 5), revenue=2.0),
        dict(order_date=datetime(2026, 3, 20, 23), revenue=4.0),
        dict(order_date=datetime(2026, 3, 21), revenue=8.0),
        dict(order_date=datetime(2025, 3, 21), revenue=16.0),
    )
    got = sales.ytd_revenue_by_month(df, 2026, AS_OF).collect()
    assert [tuple(r) for r in got] == [("2026-01", 1.0), ("2026-02", 2.0), ("2026-03", 4.0)]


def test_top_sellers_cut_ties_by_key(spark):
    df = orders(
        spark,
        dict(product_id="p3", revenue=10.0),
        dict(product_id="p2", revenue=10.0),
        dict(product_id="p1", revenue=5.0, unit_price=10.0),
        dict(product_id="p1", revenue=15.0, unit_price=15.0, order_id="o2"),
    )
    got = sales.top_sellers(df, AS_OF, AS_OF, 2).collect()
    assert [r.product_id for r in got] == ["p1", "p2"]
    assert (got[0].order_count, got[0].avg_price) == (2, 13.0)


def test_date_columns_work_as_well_as_timestamps(spark):
    from pyspark.sql import functions as F

    df = orders(spark, dict(), dict(order_date=back(1)))
    for kind in ("date", "timestamp"):
        cast = df.withColumn("order_date", F.col("order_date").cast(kind))
        assert only(sales.daily_sales_summary(cast, AS_OF)).order_count == 1
        assert only(sales.weekly_trend(cast, AS_OF)).revenue == 200.0


def test_month_of_a_leap_day():
    from shelfmetrics.functions.days import month_days

    assert month_days("2024-02") == (date(2024, 2, 1), date(2024, 2, 29))
    assert month_days("2024-02", 1) == (date(2023, 2, 1), date(2023, 2, 28))
    assert month_days("2025-12") == (date(2025, 12, 1), date(2025, 12, 31))
