from datetime import date

import pytest

from rows import AS_OF, back, by, inventory, only, orders
from shelfmetrics.operators import inventory as ops


def sale(days, qty=10, **more):
    return dict(order_date=back(days), quantity=qty, **more)


def test_window_spans_31_days_and_ends_today(spark):
    df = orders(spark, sale(30, 4), sale(31, 100), sale(-1, 100))
    row = only(ops.stock_status(inventory(spark, {}), df, AS_OF))
    assert (row.avg_daily_sales, row.days_of_stock) == (4.0, 25.0)


def test_mean_runs_over_days_with_sales(spark):
    df = orders(spark, sale(1), sale(10), sale(20))
    assert only(ops.stock_status(inventory(spark, {}), df, AS_OF)).avg_daily_sales == 10.0


def test_sku_without_sales_is_kept_last_and_slow(spark):
    stock = inventory(spark, dict(sku="idle"), dict(sku="s1", current_stock=60))
    got = ops.stock_status(stock, orders(spark, sale(1)), AS_OF).collect()
    assert [r.sku for r in got] == ["s1", "idle"]
    assert (got[1].days_of_stock, got[1].status) == (None, "⚪ 저회전")
    assert got[0].status == "🔴 긴급"


@pytest.mark.parametrize(
    "stock, status",
    [(69, "🔴 긴급"), (70, "🟡 주의"), (139, "🟡 주의"), (140, "🟢 양호"), (299, "🟢 양호"), (300, "⚪ 저회전")],
)
def test_stock_status_limits(spark, stock, status):
    df = ops.stock_status(inventory(spark, dict(current_stock=stock)), orders(spark, sale(1)), AS_OF)
    assert only(df).status == status


def test_demand_is_global_per_sku(spark):
    stock = inventory(spark, dict(warehouse="own"), dict(warehouse="far", current_stock=30))
    got = by(ops.stock_status(stock, orders(spark, sale(1)), AS_OF), "warehouse")
    assert {r.avg_daily_sales for r in got.values()} == {10.0}
    assert (got["own"].days_of_stock, got["far"].days_of_stock) == (10.0, 3.0)


def test_forecast_windows_and_acceleration(spark):
    df = orders(spark, sale(7, 20), sale(8, 10), sale(14, 12), sale(15, 30), sale(31, 999))
    row = only(ops.depletion_forecast(inventory(spark, {}), df, AS_OF))
    assert (row.ma_7d, row.ma_14d, row.ma_30d) == (20.0, 14.0, 18.0)
    assert row.weekly_acceleration == 9.0  # 20 against the mean of 10 and 12
    assert (row.depletion_days_7d, row.depletion_days_14d, row.depletion_days_30d) == (5, 7, 6)
    assert row.estimated_depletion_date == date(2026, 3, 25)
    assert row.trend_pct == 11.1
    assert (row.forecast_status, row.trend_direction) == ("🔴 7일 내 소진", "↗️ 증가")


def test_forecast_with_one_day_has_no_variation(spark):
    row = only(ops.depletion_forecast(inventory(spark, {}), orders(spark, sale(1)), AS_OF))
    assert (row.demand_cv_pct, row.weekly_acceleration) == (None, None)
    assert (row.trend_pct, row.trend_direction) == (0.0, "↘️ 감소")


def test_forecast_leaves_out_skus_without_recent_sales(spark):
    df = ops.depletion_forecast(inventory(spark, {}), orders(spark, sale(8)), AS_OF)
    assert df.count() == 0


def test_two_names_of_a_sku_make_two_daily_rows_in_the_forecast_only(spark):
    df = orders(spark, sale(1, 10, product_name="B"), sale(1, 20, product_name="A"))
    stock = inventory(spark, {})
    forecast = only(ops.depletion_forecast(stock, df, AS_OF))
    assert (forecast.product_name, forecast.ma_7d) == ("A", 15.0)
    assert only(ops.stock_status(stock, df, AS_OF)).avg_daily_sales == 30.0


def test_reorder_with_one_sale_day_and_default_lead_time(spark):
    row = only(
        ops.reorder_alert(inventory(spark, dict(current_stock=70)), orders(spark, sale(1)), AS_OF)
    )
    assert (row.sales_stddev, row.safety_stock, row.lead_time_days) == (0.0, 0.0, 7)
    assert (row.lead_time_demand, row.reorder_point, row.order_quantity) == (70.0, 70.0, 0.0)
    assert (row.days_of_stock, row.days_until_reorder) == (7.0, 0.0)
    assert row.alert_level == "🟡 발주필요"


def test_reorder_lead_time_and_safety_stock(spark):
    df = orders(spark, sale(1, 10), sale(2, 20))
    row = only(ops.reorder_alert(inventory(spark, dict(current_stock=5)), df, AS_OF, lead_time=14))
    # mean 15, sigma 7.0711: 1.65 * 7.0711 * sqrt(14) = 43.65
    assert (row.sales_stddev, row.safety_stock) == (7.1, 44.0)
    assert (row.lead_time_demand, row.reorder_point, row.order_quantity) == (210.0, 254.0, 249.0)
    assert row.alert_level == "🔴 긴급발주"


def test_reorder_leaves_out_ample_and_unsold_stock(spark):
    stock = inventory(
        spark,
        dict(warehouse="at limit", current_stock=84),
        dict(warehouse="ample", current_stock=85),
        dict(sku="idle", current_stock=0),
    )
    row = only(ops.reorder_alert(stock, orders(spark, sale(1)), AS_OF))
    assert (row.warehouse, row.alert_level) == ("at limit", "🟢 발주임박")


def test_reorder_sorts_by_urgency(spark):
    df = orders(spark, sale(1, 10), sale(2, 30))
    stocks = dict(soon=215, due=150, urgent=50, urgent_less=10)
    stock = inventory(spark, *[dict(warehouse=w, current_stock=n) for w, n in stocks.items()])
    got = ops.reorder_alert(stock, df, AS_OF).collect()
    assert [r.warehouse for r in got] == ["urgent_less", "urgent", "due", "soon"]


def test_order_plan_follows_the_worked_example(spark):
    planned = spark.createDataFrame(
        [("s", "w", 30, 12.3, 20.0, 110.0, 2.0)],
        "sku string, warehouse string, current_stock long, avg_daily_sales double, "
        "safety_stock double, reorder_point double, days_of_stock double",
    )
    row = only(ops.order_plan(planned))
    assert (row.order_quantity, row.days_until_reorder) == (80.0, -7.0)


def test_rocket_risk_uses_one_channel_and_warehouse(spark):
    rocket = ops.ROCKET
    df = orders(
        spark,
        sale(7, 20, channel=rocket),
        sale(8, 10, channel=rocket),
        sale(14, 12, channel=rocket),
        sale(15, 500, channel=rocket),
        sale(1, 500),
    )
    stock = inventory(spark, dict(warehouse=rocket, current_stock=28), dict(current_stock=1))
    row = only(ops.rocket_delivery_risk(stock, df, AS_OF))
    assert (row.rocket_stock, row.avg_daily_sales, row.peak_daily_sales) == (28, 14.0, 20.0)
    assert (row.days_remaining, row.risk_level) == (2.0, "🚨 즉시 입고")
    assert row.sales_acceleration_pct == 81.8


@pytest.mark.parametrize(
    "stock, level",
    [(29, "🚨 즉시 입고"), (30, "⚠️ 입고 필요"), (70, "📋 모니터링"), (139, "📋 모니터링"), (140, None)],
)
def test_rocket_risk_limits(spark, stock, level):
    got = ops.rocket_delivery_risk(
        inventory(spark, dict(current_stock=stock)), orders(spark, sale(1)), AS_OF, "web", "own"
    ).collect()
    assert [r.risk_level for r in got] == ([level] if level else [])


def test_counts_and_urgent_list(spark):
    stock = inventory(
        spark,
        dict(warehouse="own", current_stock=10),
        dict(warehouse="far", current_stock=20),
        dict(warehouse="mid", current_stock=100),
    )
    df = orders(spark, sale(1))
    status = ops.stock_status(stock, df, AS_OF)
    risk = ops.rocket_delivery_risk(stock, df, AS_OF, "web", "own")
    assert tuple(only(ops.stock_status_counts(status))) == (2, 1)
    listed = sorted(tuple(r) for r in ops.urgent_sku_list(status, risk).collect())
    assert listed == [("로켓", "s1", "Case", 1.0), ("재고", "s1", "Case", 1.0), ("재고", "s1", "Case", 2.0)]
    assert tuple(only(ops.inventory_alert_summary(status, risk))) == (2, 1, 1, 3)


def test_unknown_stock_is_kept_ungraded(spark):
    df = orders(spark, sale(1))
    stock = inventory(spark, dict(current_stock=None))
    assert only(ops.stock_status(stock, df, AS_OF)).status == "⚪ 저회전"
    assert only(ops.depletion_forecast(stock, df, AS_OF)).estimated_depletion_date is None
    assert ops.reorder_alert(stock, df, AS_OF).count() == 0


def test_hot_sku_gives_the_same_rows_for_any_number_of_salts(spark):
    from shelfmetrics.functions.joins import join_stats

    rows = inventory(spark, *[dict(warehouse=f"w{i}") for i in range(50)], dict(sku=None))
    stats = spark.createDataFrame([("s1", 2.0), ("s9", 3.0)], "sku string, mean double")
    for salts in (1, 3, 8):
        left = join_stats(rows, stats, ["sku"], ["warehouse"], "left", salts)
        assert left.count() == 51
        assert left.where("mean = 2.0").count() == 50
        assert join_stats(rows, stats, ["sku"], ["warehouse"], "inner", salts).count() == 50
