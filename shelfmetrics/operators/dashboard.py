"""Item and value rows of the monthly dashboard."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Item names, in the order they are printed.
ITEM_REVENUE = "당월 매출"
ITEM_YOY = "매출 YoY 증감률"
ITEM_TARGET_PCT = "목표 달성률"
ITEM_TARGET = "매출 목표"
ITEM_CRITICAL = "긴급 SKU"
ITEM_WARNING = "주의 SKU"
NOT_AVAILABLE = "N/A"

# The other texts of the printed summary, in the order they are printed.
PRINT_TITLE, PRINT_UPDATED = "월간 비즈니스 리포트", "최종 업데이트"
PRINT_HEADER = ("항목", "값")
PRINT_STOCK, PRINT_SHEETS = "재고 현황", "시트별 상세"
PRINT_SHEET_LINES = [
    ("매출요약", "채널별/카테고리별 YoY 비교"),
    ("베스트셀러", "TOP 20 상품 매출순"),
    ("재고현황", "전 SKU 재고 소진 예측"),
    ("광고성과", "캠페인별 ROAS 분석"),
]


def plain_number(value: Decimal | int | float) -> str:
    """A number without exponent or trailing zeros."""
    text = format(Decimal(str(value)), "f")
    return text.rstrip("0").rstrip(".") if "." in text else text


def monthly_kpi_dashboard(
    summary: DataFrame, stock_counts: DataFrame, target: Decimal | int | float
) -> DataFrame:
    """Revenue, growth, target and stock risk as ordered (item, value) text rows.

    Both inputs are single rows. The stock counts come in as scalar subqueries.
    """

    def percent(column: str) -> Column:
        text = F.col(column).cast("decimal(38,1)").cast("string")
        return F.concat(F.coalesce(text, F.lit(NOT_AVAILABLE)), F.lit("%"))

    revenue = F.col("cur_revenue").cast("decimal(38,2)").cast("string")
    items = [
        (ITEM_REVENUE, F.coalesce(revenue, F.lit("0"))),
        (ITEM_YOY, percent("revenue_yoy_pct")),
        (ITEM_TARGET_PCT, percent("target_achievement_pct")),
        (ITEM_TARGET, F.lit(plain_number(target))),
        (ITEM_CRITICAL, stock_counts.select("critical_count").scalar().cast("string")),
        (ITEM_WARNING, stock_counts.select("warning_count").scalar().cast("string")),
    ]
    rows = [
        F.struct(F.lit(i).alias("position"), F.lit(item).alias("item"), value.alias("value"))
        for i, (item, value) in enumerate(items, start=1)
    ]
    return summary.select(F.inline(F.array(*rows)))


def printed_summary(kpis: DataFrame, month: str, updated: str) -> DataFrame:
    """The summary tab line by line, as (position, item, value): title and month, time of update,
    the dashboard's items under their headings, and a line for each other tab. Blank lines are
    empty, headings have no value."""
    money, stock = 4, 2  # items above and below the stock heading
    lines: list[tuple[str, str | None] | int] = [
        (PRINT_TITLE, month), (PRINT_UPDATED, updated), ("", None), PRINT_HEADER, money,
        ("", None), (PRINT_STOCK, None), stock, ("", None), (PRINT_SHEETS, None), *PRINT_SHEET_LINES,
    ]
    fixed, place, item, at = [], F.lit(None).cast("int"), 0, 0
    for line in lines:
        if isinstance(line, int):
            place = F.when(F.col("position").between(item + 1, item + line), F.col("position") + (at - item)).otherwise(place)
            item, at = item + line, at + line
        else:
            at += 1
            fixed.append((at, *line))
    texts = kpis.sparkSession.createDataFrame(fixed, "position int, item string, value string")
    return kpis.select(place.alias("position"), "item", "value").unionByName(texts).orderBy("position")
