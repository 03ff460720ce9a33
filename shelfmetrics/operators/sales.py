"""Sales reports over order lines."""

from __future__ import annotations

from datetime import date
from decimal import Decimal

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, as_date, in_days, month_days, trailing_days, week_start
from shelfmetrics.functions.labels import TOTAL_CATEGORY, TOTAL_CHANNEL
from shelfmetrics.functions.metrics import (
    change_pct,
    money_sum,
    pct,
    round_half_away,
    safe_div,
    steady_avg,
)

_CURRENT, _LAST_YEAR = "cur", "yoy"


def daily_sales_summary(orders: DataFrame, day: Day) -> DataFrame:
    """Orders, quantity, revenue, cost and margin of one day per channel and category."""
    day = as_date(day)
    totals = (
        orders.where(in_days("order_date", day, day))
        .groupBy("channel", "category")
        .agg(
            F.count_distinct("order_id").alias("order_count"),
            F.sum("quantity").alias("total_qty"),
            money_sum("revenue").alias("total_revenue"),
            money_sum("cost").alias("total_cost"),
        )
        .withColumn("gross_profit", F.col("total_revenue") - F.col("total_cost"))
    )
    return totals.select(
        F.lit(day).alias("sale_date"),
        "channel",
        "category",
        "order_count",
        "total_qty",
        "total_revenue",
        "total_cost",
        "gross_profit",
        (safe_div("gross_profit", "total_revenue") * 100).alias("gpm_pct"),
    ).orderBy(F.desc("total_revenue"), "channel", "category")


def weekly_trend(orders: DataFrame, as_of: Day, weeks: int = 12) -> DataFrame:
    """Revenue, profit and week-on-week change per Monday week and channel.

    The change compares with the channel's previous week that has sales. The
    window only sees aggregated rows: at most ``weeks + 1`` per channel.
    """
    totals = (
        orders.where(trailing_days("order_date", as_of, 7 * weeks))
        .withColumn("week_start", week_start("order_date"))
        .groupBy("week_start", "channel")
        .agg(
            F.count_distinct("order_id").alias("orders"),
            money_sum("revenue").alias("revenue"),
            money_sum("cost").alias("cost"),
        )
        .withColumn("profit", F.col("revenue") - F.col("cost"))
    )
    by_week = Window.partitionBy("channel").orderBy("week_start")
    return (
        totals.withColumn("previous", F.lag("revenue").over(by_week))
        .select(
            "week_start",
            "channel",
            "orders",
            "revenue",
            "profit",
            pct("profit", "revenue").alias("gpm_pct"),
            change_pct("revenue", "previous").alias("wow_change_pct"),
        )
        .orderBy(F.desc("week_start"), F.desc("revenue"), "channel")
    )


def _year_to_date(year: int, as_of: Day) -> Column:
    last = min(date(year, 12, 31), as_date(as_of))
    return in_days("order_date", date(year, 1, 1), last)


def ytd_revenue_by_month(orders: DataFrame, year: int, as_of: Day) -> DataFrame:
    """Revenue of each month of a year, up to ``as_of`` (month totals, not running)."""
    return (
        orders.where(_year_to_date(year, as_of))
        .groupBy(F.date_format("order_date", "yyyy-MM").alias("month"))
        .agg(money_sum("revenue").alias("cumulative_revenue"))
        .orderBy("month")
    )


def monthly_cells(orders: DataFrame, month: str, as_of: Day | None = None) -> DataFrame:
    """Measures per period, channel and category: the month and its last-year twin.

    One pass over the order lines serves both months, and with ``as_of`` the
    year-to-date revenue too (in rows of their own where the period is NULL).
    Order ids outside the two months are blanked, so they cost the distinct count
    nothing.
    """
    current = in_days("order_date", *month_days(month))
    last_year = in_days("order_date", *month_days(month, years_back=1))
    wanted = current | last_year
    to_date = F.lit(False)
    if as_of is not None:
        to_date = _year_to_date(int(month[:4]), as_of)
        wanted = wanted | to_date
    return (
        orders.where(wanted)
        .withColumn("period", F.when(current, _CURRENT).when(last_year, _LAST_YEAR))
        .withColumn("period_order", F.when(F.col("period").isNotNull(), F.col("order_id")))
        .withColumn("ytd_revenue", F.when(to_date, F.col("revenue")))
        .groupBy("period", "channel", "category")
        .agg(
            F.count_distinct("period_order").alias("orders"),
            F.sum("revenue").alias("revenue"),
            F.sum("cost").alias("cost"),
            F.sum("ytd_revenue").alias("ytd_revenue"),
        )
    )


def _both_periods(pick) -> list[Column]:
    """Current and last-year version of each measure, as doubles where money."""
    return [
        pick(period, measure, kind).alias(f"{period}_{measure}")
        for period in (_CURRENT, _LAST_YEAR)
        for measure, kind in (("orders", "bigint"), ("revenue", "double"), ("cost", "double"))
    ]


def _with_profit(cells: DataFrame) -> DataFrame:
    return cells.withColumns(
        {f"{p}_profit": F.col(f"{p}_revenue") - F.col(f"{p}_cost") for p in (_CURRENT, _LAST_YEAR)}
    )


def _yoy_changes() -> list[Column]:
    return [
        change_pct(f"{_CURRENT}_{m}", f"{_LAST_YEAR}_{m}").alias(f"{m}_yoy_pct")
        for m in ("revenue", "orders", "profit")
    ]


def monthly_comparison_detail(
    orders: DataFrame,
    month: str,
    target: Decimal | int | float,
    cells: DataFrame | None = None,
) -> DataFrame:
    """Month against the same month last year, per channel and category.

    A cell sold in only one of the months shows zeros for the other and no
    year-on-year change. Cells with a NULL channel or category never pair up.
    """
    cells = monthly_cells(orders, month) if cells is None else cells
    unpaired = F.when(F.col("channel").isNull() | F.col("category").isNull(), F.col("period"))
    paired = (
        cells.where(F.col("period").isNotNull())
        .withColumn("unpaired", unpaired)
        .groupBy("channel", "category", "unpaired")
        .agg(
            *_both_periods(
                lambda period, measure, kind: F.max(
                    F.when(F.col("period") == period, F.col(measure))
                ).cast(kind)
            )
        )
    )
    zero = {"orders": F.lit(0).cast("bigint")}

    def shown(period: str, measure: str) -> Column:
        name = f"{period}_{measure}"
        return F.coalesce(name, zero.get(measure, F.lit(0.0))).alias(name)

    def margin(period: str) -> Column:
        value = pct(f"{period}_profit", f"{period}_revenue")
        return F.coalesce(value, F.lit(0.0)).alias(f"{period}_gpm_pct")

    sides = []
    for period in (_CURRENT, _LAST_YEAR):
        sides += [shown(period, m) for m in ("orders", "revenue", "profit")] + [margin(period)]
    return (
        _with_profit(paired)
        .select(
            "channel",
            "category",
            *sides,
            *_yoy_changes(),
            pct("cur_revenue", F.lit(float(target))).alias("target_contribution_pct"),
        )
        .orderBy(F.desc("cur_revenue"), "channel", "category")
    )


def monthly_comparison_summary(
    orders: DataFrame,
    month: str,
    target: Decimal | int | float,
    as_of: Day,
    cells: DataFrame | None = None,
) -> DataFrame:
    """One total row: both months, target achievement and year-to-date revenue.

    Order counts add up the cells, so an order in two categories counts twice.
    """
    cells = monthly_cells(orders, month, as_of) if cells is None else cells
    totals = cells.agg(
        *_both_periods(
            lambda period, measure, kind: F.sum(
                F.when(F.col("period") == period, F.col(measure))
            ).cast(kind)
        ),
        money_sum("ytd_revenue").alias("ytd_revenue"),
    )
    sides = []
    for period in (_CURRENT, _LAST_YEAR):
        sides += [F.col(f"{period}_{m}") for m in ("orders", "revenue", "profit")]
        sides.append(pct(f"{period}_profit", f"{period}_revenue").alias(f"{period}_gpm_pct"))
    return _with_profit(totals).select(
        F.lit(TOTAL_CHANNEL).alias("channel"),
        F.lit(TOTAL_CATEGORY).alias("category"),
        *sides,
        *_yoy_changes(),
        pct("cur_revenue", F.lit(float(target))).alias("target_achievement_pct"),
        "ytd_revenue",
    )


def top_sellers(orders: DataFrame, start: Day, end: Day, n: int) -> DataFrame:
    """The ``n`` products with the highest revenue; equal revenue is cut by key."""
    product = ["product_id", "product_name", "sku"]
    return (
        orders.where(in_days("order_date", start, end))
        .groupBy(*product)
        .agg(
            F.sum("quantity").alias("total_qty"),
            money_sum("revenue").alias("total_revenue"),
            F.count_distinct("order_id").alias("order_count"),
            round_half_away(steady_avg("unit_price")).alias("avg_price"),
            money_sum("cost").alias("total_cost"),
        )
        .withColumn(
            "gpm_pct", pct(F.col("total_revenue") - F.col("total_cost"), "total_revenue")
        )
        .drop("total_cost")
        .orderBy(F.desc("total_revenue"), *product)
        .limit(n)
    )
