"""What the tabs of a bundle share, computed in one pass over the facts and written once.

A base has the columns of the table it stands for, so every report runs on it unchanged. Bases of
whole days are sums per day and key: reports that add up days, or sort them by key, cannot tell
the difference. Counts of distinct orders need the lines themselves, cut to the days in question.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, in_days
from shelfmetrics.scratch import written

_MEASURES = ["impressions", "clicks", "ad_spend", "attributed_orders", "attributed_revenue"]


def _any(column: str, ranges: list[tuple[Day, Day]]) -> Column:
    return reduce(Column.__or__, [in_days(column, *days) for days in ranges])


def demand_base(orders: DataFrame, first: Day, last: Day) -> DataFrame:
    """Units per SKU, name, channel and day: all that stock reports read of the order lines."""
    sums = (
        orders.where(in_days("order_date", first, last))
        .groupBy("sku", "product_name", "channel", F.to_date("order_date").alias("order_date"))
        .agg(F.sum("quantity").alias("quantity"))
    )
    return written(sums, "demand-base")


def line_base(orders: DataFrame, ranges: list[tuple[Day, Day]]) -> DataFrame:
    """The order lines of some ranges of days."""
    return written(orders.where(_any("order_date", ranges)), "line-base")


def ad_base(facts: DataFrame, ranges: list[tuple[Day, Day]]) -> DataFrame:
    """Ad measures per day and key, where the keys are all columns that are no measures."""
    keys = [c for c in facts.columns if c not in (*_MEASURES, "report_date")]
    sums = (
        facts.where(_any("report_date", ranges))
        .groupBy(*keys, F.to_date("report_date").alias("report_date"))
        .agg(*[F.sum(m).alias(m) for m in _MEASURES])
    )
    return written(sums, "ad-base")
