"""Product reports: margins and price positions.

The price reports read one aggregated base twice, once for category statistics
and once for the products. Pass the same ``base`` to several of them, persisted,
and the order lines are scanned once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, in_days
from shelfmetrics.functions.joins import join_stats
from shelfmetrics.functions.labels import GPM_TIER, PRICE_BAND, PRICE_TIER, competitiveness, grade
from shelfmetrics.functions.metrics import (
    money_sum,
    pct,
    round_half_away,
    safe_div,
    steady_avg,
)
from shelfmetrics.functions.positions import with_position

_PRODUCT = ["sku", "product_name", "category", "channel"]
_SHELF = ["category", "channel"]


def gpm_analysis(orders: DataFrame, start: Day, end: Day, min_qty: int = 10) -> DataFrame:
    """Revenue, cost, margin and margin tier per product and channel."""
    return (
        orders.where(in_days("order_date", start, end))
        .groupBy(*_PRODUCT)
        .agg(
            F.sum("quantity").alias("total_qty"),
            money_sum("revenue").alias("sales"),
            money_sum("cost").alias("costs"),
            steady_avg("unit_price").alias("mean_price"),
            steady_avg("unit_cost").alias("mean_cost"),
        )
        .where(F.col("total_qty") >= min_qty)
        .withColumn("profit", F.col("sales") - F.col("costs"))
        .withColumn("margin", safe_div("profit", "sales"))
        .select(
            *_PRODUCT,
            "total_qty",
            round_half_away("sales").alias("revenue"),
            round_half_away("costs").alias("cogs"),
            round_half_away("profit").alias("gross_profit"),
            round_half_away(F.col("margin") * 100, 1).alias("gpm_pct"),
            round_half_away("mean_price").alias("avg_selling_price"),
            round_half_away("mean_cost").alias("avg_unit_cost"),
            grade(F.col("margin"), GPM_TIER).alias("gpm_tier"),
        )
        .orderBy(F.desc("gross_profit"), *_PRODUCT)
    )


def product_prices(orders: DataFrame, start: Day, end: Day) -> DataFrame:
    """Mean line price, quantity, revenue and mean line margin per product and channel."""
    line_margin = safe_div(F.col("unit_price") - F.col("unit_cost"), "unit_price")
    return (
        orders.where(in_days("order_date", start, end))
        .groupBy(*_PRODUCT)
        .agg(
            steady_avg("unit_price").alias("mean_price"),
            F.sum("quantity").alias("total_qty"),
            money_sum("revenue").alias("sales"),
            (steady_avg(line_margin) * 100).alias("mean_margin_pct"),
        )
    )


def category_price_stats(
    orders: DataFrame, start: Day, end: Day, base: DataFrame | None = None
) -> DataFrame:
    """Price mean, range, 101 quantiles and SKU count per category and channel.

    The mean is the plain mean of the product means. Quantile i is the known price of rank
    ceil(i / 100 * n), at least 1, of the shelf's n known prices; without any there is no array.
    """
    base = product_prices(orders, start, end) if base is None else base
    # Apart from the distinct count, which would repeat every row.
    return (
        _shelf_stats(base)
        .withColumn("_shelf", F.struct(*_SHELF))
        .join(_shelf_quantiles(base), "_shelf", "left")
        .select(
            *_SHELF, "cat_avg_price", "cat_min_price", "cat_max_price", "price_quantiles", "sku_count"
        )
    )


def _shelf_quantiles(base: DataFrame) -> DataFrame:
    """Exact quantiles per shelf. Prices are numbered over ranges, so no task holds a shelf; the
    price in place p of n has the quantiles i with ceil(i / 100 * n) = p. A shelf is a struct, which
    also matches where a part of it is NULL."""
    prices = base.where(F.col("mean_price").isNotNull()).select(*_SHELF, F.col("mean_price").alias("_price"))
    placed = with_position(prices, [F.col("_price")], _SHELF, "_place", "_size")
    return (
        placed.select(
            F.struct(*_SHELF).alias("_shelf"),
            "_price",
            F.expr("if(_place = 1, 0, (_place - 1) * 100 div _size + 1)").alias("_first"),
            F.expr("_place * 100 div _size").alias("_last"),
        )
        .where("_first <= _last")
        .groupBy("_shelf")
        .agg(F.sort_array(F.collect_list(F.struct("_first", "_last", "_price"))).alias("_steps"))
        .select(
            "_shelf",
            F.expr(
                "flatten(transform(_steps, s -> "
                "array_repeat(s._price, cast(s._last - s._first + 1 as int))))"
            ).alias("price_quantiles"),
        )
    )


def _shelf_stats(base: DataFrame) -> DataFrame:
    return base.groupBy(*_SHELF).agg(
        steady_avg("mean_price").alias("cat_avg_price"),
        F.min("mean_price").alias("cat_min_price"),
        F.max("mean_price").alias("cat_max_price"),
        F.count_distinct("sku").alias("sku_count"),
    )


def _on_shelf(base: DataFrame) -> DataFrame:
    """Products next to the statistics of their category and channel."""
    return join_stats(base, _shelf_stats(base), _SHELF, ["sku", "product_name"])


def price_bands(
    orders: DataFrame, start: Day, end: Day, base: DataFrame | None = None
) -> DataFrame:
    """SKUs, quantity, mean price and mean margin per category, channel and price band."""
    base = product_prices(orders, start, end) if base is None else base
    return (
        _on_shelf(base)
        .withColumn("price_band", grade(F.col("mean_price"), PRICE_BAND, F.col("cat_avg_price")))
        .groupBy(*_SHELF, "price_band")
        .agg(
            F.count_distinct("sku").alias("sku_count"),
            F.sum("total_qty").alias("band_total_qty"),
            round_half_away(steady_avg("mean_price")).alias("band_avg_price"),
            round_half_away(steady_avg("mean_margin_pct"), 1).alias("band_avg_margin_pct"),
        )
        .orderBy(*_SHELF, "price_band")
    )


def price_order() -> list[Column]:
    """The order of the price report: by category, dearest first."""
    return [F.col("category"), F.desc("price_percentile"), *map(F.col, ("channel", "sku", "product_name"))]


def price_competitiveness(
    orders: DataFrame, start: Day, end: Day, base: DataFrame | None = None, min_qty: int = 5
) -> DataFrame:
    """Price index, position, tier and verdict per product within its category and channel."""
    return price_rows(orders, start, end, base, min_qty).orderBy(*price_order())


def price_rows(
    orders: DataFrame, start: Day, end: Day, base: DataFrame | None = None, min_qty: int = 5
) -> DataFrame:
    """The price report without its order.

    Products under ``min_qty`` count towards the category statistics and are left
    out only afterwards.
    """
    base = product_prices(orders, start, end) if base is None else base
    price, mean = F.col("mean_price"), F.col("cat_avg_price")
    lowest, highest = F.col("cat_min_price"), F.col("cat_max_price")
    return (
        _on_shelf(base)
        .where(F.col("total_qty") >= min_qty)
        .select(
            *_PRODUCT,
            round_half_away(price).alias("avg_selling_price"),
            round_half_away(mean).alias("category_avg_price"),
            pct(price, mean).alias("price_index"),
            pct(price - lowest, highest - lowest).alias("price_percentile"),
            "total_qty",
            round_half_away("sales").alias("revenue"),
            round_half_away("mean_margin_pct", 1).alias("margin_pct"),
            grade(price, PRICE_TIER, mean).alias("price_tier"),
            competitiveness(price, mean, F.col("mean_margin_pct"), F.col("total_qty")).alias(
                "competitiveness_label"
            ),
            pct(price, highest).alias("pct_of_max_price"),
            F.col("sku_count").alias("category_sku_count"),
        )
    )
