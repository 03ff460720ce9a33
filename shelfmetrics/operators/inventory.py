"""Inventory reports: order lines give demand, stock rows give supply.

Demand is global per SKU and is attached to every warehouse row of that SKU.
Means run over days that had sales. Every demand aggregate goes through a
(SKU, day) step with a map-side combine, so a hot SKU reaches the second step as
one row per day.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, as_date, days_before, trailing_days
from shelfmetrics.functions.daysets import days_within, merged
from shelfmetrics.functions.labels import (
    DELIVERY_IMMEDIATE,
    DELIVERY_RISK,
    FORECAST_STATUS,
    REORDER_DUE,
    REORDER_URGENT,
    STOCK_CRITICAL,
    STOCK_STATUS,
    STOCK_WARNING,
    TREND_DIRECTION,
    grade,
    reorder_alert_level,
)
from shelfmetrics.functions.metrics import change_pct, exact_stddev, pct, round_half_away, safe_div

SERVICE_FACTOR = 1.65  # 95 % service level
ACTIVE_WINDOWS = (7, 14, 30, 60)  # days of the depletion forecast
LAST_DAY = 2_900_000  # days; dates go to the year 9999
ROCKET = "coupang_rocket"  # fixed value: the fulfilment channel and its warehouse


def daily_demand(orders: DataFrame, as_of: Day, days: int, *more_keys: str) -> DataFrame:
    """Units sold per SKU (and further keys) and day over the trailing window."""
    return (
        orders.where(trailing_days("order_date", as_of, days))
        .withColumn("sale_date", F.to_date("order_date"))
        .groupBy("sku", *more_keys, "sale_date")
        .agg(F.sum("quantity").alias("daily_qty"))
    )


def _mean_when(condition: Column) -> Column:
    return F.avg(F.when(condition, F.col("daily_qty")))


def stock_order() -> list[Column]:
    """The order of the stock report: soonest out of stock first, without an end last."""
    return [F.asc_nulls_last("days_of_stock"), F.col("sku"), F.col("warehouse")]


def stock_status(
    inventory: DataFrame, orders: DataFrame, as_of: Day, window_days: int = 30
) -> DataFrame:
    """Every stock row with mean daily sales, days of stock and a four-step status."""
    return stock_rows(inventory, orders, as_of, window_days).orderBy(*stock_order())


def stock_rows(
    inventory: DataFrame, orders: DataFrame, as_of: Day, window_days: int = 30
) -> DataFrame:
    """The stock report without its order."""
    demand = (
        daily_demand(orders, as_of, window_days)
        .groupBy("sku")
        .agg(F.avg("daily_qty").alias("mean_qty"))
    )
    return _stock_days(inventory.join(demand, "sku", "left"))


def stock_status_daily(
    inventory: DataFrame, orders: DataFrame, first: Day, last: Day, window_days: int = 30
) -> DataFrame:
    """The stock report as of every day of a range, for today's stock: ``as_of`` and its columns.

    One scan serves all days. A day's sales enter the window on that day and leave it after its
    last one; sums of what enters and leaves, day by day, are the window's sums on each day. So a
    sale is two rows, however long the window and the range are.
    """
    first, last = as_date(first), as_date(last)
    sold = daily_demand(orders, last, (last - first).days + window_days).where("daily_qty is not null")
    left = F.date_add("sale_date", window_days + 1)
    moves = sold.select("sku", F.inline(F.array(
        F.struct(F.col("sale_date").alias("day"), F.col("daily_qty").alias("qty"), F.lit(1).alias("days")),
        F.struct(left.alias("day"), (-F.col("daily_qty")).alias("qty"), F.lit(-1).alias("days")),
    )))
    days = F.sequence(F.lit(first), F.lit(last))
    asked = inventory.select("sku").distinct().select("sku", F.explode(days).alias("day"))
    # what moved before the range is one row a SKU, and none of it comes after the range
    start = F.greatest(F.col("day"), F.lit(first))
    moved = moves.where(F.col("day") <= F.lit(last)).groupBy("sku", start.alias("day")).agg(
        F.sum("qty").alias("qty"), F.sum("days").alias("days")
    )
    so_far = Window.partitionBy("sku").orderBy("day").rowsBetween(Window.unboundedPreceding, 0)
    sums = asked.join(moved, ["sku", "day"], "left").select(
        "sku", F.col("day").alias("as_of"),
        F.coalesce(F.sum("qty").over(so_far), F.lit(0)).alias("qty"),
        F.coalesce(F.sum("days").over(so_far), F.lit(0)).alias("sale_days"),
    )
    means = sums.select("sku", "as_of", safe_div("qty", "sale_days").alias("mean_qty"))
    return _stock_days(inventory.join(means, "sku"), "as_of")


def _stock_days(stock: DataFrame, *more: str) -> DataFrame:
    days = F.when(F.col("mean_qty") > 0, safe_div("current_stock", "mean_qty"))
    return (
        stock.withColumn("days", days)
        .select(
            *more,
            "sku",
            "product_name",
            "warehouse",
            "current_stock",
            round_half_away("mean_qty", 1).alias("avg_daily_sales"),
            round_half_away("days").alias("days_of_stock"),
            grade(F.col("days"), STOCK_STATUS).alias("status"),
        )
    )


def depletion_forecast(inventory: DataFrame, orders: DataFrame, as_of: Day) -> DataFrame:
    """Depletion days from 7, 14 and 30 day means, with trend and demand variation."""
    sold = F.col("sale_date")
    last_7 = sold >= days_before(as_of, 7)
    last_14 = sold >= days_before(as_of, 14)
    last_30 = sold >= days_before(as_of, 30)
    week_before = last_14 & (sold <= days_before(as_of, 8))
    demand = (
        daily_demand(orders, as_of, 60, "product_name")
        .groupBy("sku")
        .agg(
            F.min("product_name").alias("product_name"),
            _mean_when(last_7).alias("mean_7"),
            _mean_when(last_14).alias("mean_14"),
            _mean_when(last_30).alias("mean_30"),
            _mean_when(week_before).alias("mean_week_before"),
            exact_stddev(F.when(last_30, F.col("daily_qty"))).alias("sigma_30"),
        )
        .where(F.col("mean_7") > 0)
    )
    stock = inventory.select("sku", "warehouse", "current_stock")
    return (
        stock.join(demand, "sku")
        .withColumn("days_7", safe_div("current_stock", "mean_7"))
        .withColumn("trend", safe_div(F.col("mean_7") - F.col("mean_30"), "mean_30"))
        .withColumn("depletion_days_7d", round_half_away("days_7"))
        .select(
            "sku",
            "product_name",
            "warehouse",
            "current_stock",
            round_half_away("mean_7", 1).alias("ma_7d"),
            round_half_away("mean_14", 1).alias("ma_14d"),
            round_half_away("mean_30", 1).alias("ma_30d"),
            "depletion_days_7d",
            round_half_away(safe_div("current_stock", "mean_14")).alias("depletion_days_14d"),
            round_half_away(safe_div("current_stock", "mean_30")).alias("depletion_days_30d"),
            # no date for stock that lasts longer than dates go
            F.date_add(
                F.lit(as_date(as_of)),
                F.when(F.abs("depletion_days_7d") <= LAST_DAY, F.col("depletion_days_7d")).cast("int"),
            ).alias("estimated_depletion_date"),
            round_half_away(F.col("trend") * 100, 1).alias("trend_pct"),
            round_half_away(F.col("mean_7") - F.col("mean_week_before"), 2).alias(
                "weekly_acceleration"
            ),
            pct("sigma_30", "mean_30").alias("demand_cv_pct"),
            grade(F.col("days_7"), FORECAST_STATUS).alias("forecast_status"),
            grade(F.col("trend"), TREND_DIRECTION).alias("trend_direction"),
        )
        .orderBy("depletion_days_7d", "sku", "warehouse")
    )


def reorder_order() -> list[Column]:
    """The order of the reorder report: by level, then by days of stock."""
    level = F.col("alert_level")
    urgency = F.when(level == REORDER_URGENT, 1).when(level == REORDER_DUE, 2).otherwise(3)
    return [urgency.asc(), F.col("days_of_stock"), F.col("sku"), F.col("warehouse")]


def reorder_alert(
    inventory: DataFrame, orders: DataFrame, as_of: Day, lead_time: int = 7
) -> DataFrame:
    """Stock rows at or below 1.2 times their reorder point, most urgent first."""
    return reorder_rows(inventory, orders, as_of, lead_time).orderBy(*reorder_order())


def reorder_rows(
    inventory: DataFrame, orders: DataFrame, as_of: Day, lead_time: int = 7
) -> DataFrame:
    """The reorder report without its order.

    Quantities are computed from the unrounded mean and deviation; the order
    quantity, the days left and the level then use the rounded columns.
    """
    demand = (
        daily_demand(orders, as_of, 30)
        .groupBy("sku")
        .agg(
            F.avg("daily_qty").alias("mean_qty"),
            F.coalesce(exact_stddev("daily_qty"), F.lit(0.0)).alias("sigma"),
        )
        .where(F.col("mean_qty") > 0)
    )
    expected = F.col("mean_qty") * float(lead_time)
    buffer = F.lit(SERVICE_FACTOR) * F.col("sigma") * F.sqrt(F.lit(float(lead_time)))
    planned = inventory.join(demand, "sku").select(
        "sku",
        "product_name",
        "warehouse",
        "current_stock",
        round_half_away("mean_qty", 1).alias("avg_daily_sales"),
        round_half_away("sigma", 1).alias("sales_stddev"),
        F.lit(lead_time).cast("bigint").alias("lead_time_days"),
        round_half_away(expected).alias("lead_time_demand"),
        round_half_away(buffer).alias("safety_stock"),
        round_half_away(expected + buffer).alias("reorder_point"),
        round_half_away(safe_div("current_stock", "mean_qty")).alias("days_of_stock"),
    )
    return order_rows(planned)


def order_plan(planned: DataFrame) -> DataFrame:
    """Order quantity, days until reorder and alert level, in the order of the report."""
    return order_rows(planned).orderBy(*reorder_order())


def order_rows(planned: DataFrame) -> DataFrame:
    """Order quantity, days until reorder and alert level from the rounded plan columns."""
    stock, reorder_point = F.col("current_stock"), F.col("reorder_point")
    level = reorder_alert_level(stock, F.col("safety_stock"), reorder_point)
    return (
        planned.where(stock <= reorder_point * 1.2)
        .withColumn("order_quantity", F.greatest(reorder_point - stock, F.lit(0.0)))
        .withColumn(
            "days_until_reorder", round_half_away(safe_div(stock - reorder_point, "avg_daily_sales"))
        )
        .withColumn("alert_level", level)
    )


def rocket_delivery_risk(
    inventory: DataFrame,
    orders: DataFrame,
    as_of: Day,
    channel: str = ROCKET,
    warehouse: str = ROCKET,
) -> DataFrame:
    """SKUs of one fulfilment channel that its warehouse can serve for under 14 days."""
    sold = F.col("sale_date")
    recent = sold >= days_before(as_of, 7)
    demand = (
        daily_demand(orders.where(F.col("channel") == channel), as_of, 14, "product_name")
        .groupBy("sku")
        .agg(
            F.min("product_name").alias("product_name"),
            F.avg("daily_qty").alias("mean_qty"),
            F.max("daily_qty").alias("peak_qty"),
            _mean_when(recent).alias("mean_recent"),
            _mean_when(~recent).alias("mean_before"),
        )
    )
    stock = inventory.where(F.col("warehouse") == warehouse).select("sku", "current_stock")
    return (
        stock.join(demand, "sku")
        .withColumn("days", safe_div("current_stock", "mean_qty"))
        .where(F.col("days") < 14)
        .select(
            "sku",
            "product_name",
            F.col("current_stock").alias("rocket_stock"),
            round_half_away("mean_qty", 1).alias("avg_daily_sales"),
            round_half_away("peak_qty").alias("peak_daily_sales"),
            round_half_away("days").alias("days_remaining"),
            change_pct("mean_recent", "mean_before").alias("sales_acceleration_pct"),
            grade(F.col("days"), DELIVERY_RISK).alias("risk_level"),
        )
        .orderBy("days_remaining", "sku", "rocket_stock")
    )


def active_days(
    inventory: DataFrame, sets: DataFrame, as_of: Day, windows: tuple[int, ...] = ACTIVE_WINDOWS
) -> DataFrame:
    """Days with sales in each trailing window, for the SKUs whose depletion is forecast: those in
    stock that sold within the last seven days.

    ``sets`` are sets of sale days per SKU (see ``functions.daysets``), of any further keys: rows of
    one SKU are merged before days are counted.
    """
    sold = merged(sets, ["sku"])
    counts = [
        F.sum(days_within(as_date(as_of) - timedelta(days=n), as_of)).alias(f"active_days_{n}d")
        for n in windows
    ]
    per_sku = sold.groupBy("sku").agg(*counts, F.sum(days_within(as_date(as_of) - timedelta(days=7), as_of)).alias("_recent"))
    return (
        per_sku.where(F.col("_recent") > 0).drop("_recent")
        .join(inventory.select("sku"), "sku", "left_semi")
        .orderBy("sku")
    )


def stock_status_counts(status: DataFrame) -> DataFrame:
    """How many stock rows are critical and how many need attention."""
    return status.agg(
        F.count_if(F.col("status") == STOCK_CRITICAL).alias("critical_count"),
        F.count_if(F.col("status") == STOCK_WARNING).alias("warning_count"),
    )


# Where an urgent row comes from.
URGENT_FROM_STOCK, URGENT_FROM_ROCKET = "재고", "로켓"


def urgent_sku_list(status: DataFrame, risk: DataFrame) -> DataFrame:
    """Critical stock rows and immediate-inbound rows in one list, tagged by source."""

    def tagged(rows: DataFrame, source: str, days: str) -> DataFrame:
        return rows.select(
            F.lit(source).alias("source"), "sku", "product_name", F.col(days).alias("days_left")
        )

    critical = status.where(F.col("status") == STOCK_CRITICAL)
    immediate = risk.where(F.col("risk_level") == DELIVERY_IMMEDIATE)
    return tagged(critical, URGENT_FROM_STOCK, "days_of_stock").unionByName(
        tagged(immediate, URGENT_FROM_ROCKET, "days_remaining")
    )


def inventory_alert_summary(status: DataFrame, risk: DataFrame) -> DataFrame:
    """Critical, warning and immediate-inbound counts; the total is their plain sum."""
    immediate = risk.agg(F.count_if(F.col("risk_level") == DELIVERY_IMMEDIATE)).scalar()
    return (
        stock_status_counts(status)
        .withColumn("immediate_count", immediate)
        .withColumn("urgent_total", F.col("critical_count") + F.col("immediate_count"))
    )
