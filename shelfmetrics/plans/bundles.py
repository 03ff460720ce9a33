"""The four report bundles.

A bundle is a set of lazy tabs. What several tabs read (the monthly cells, the
stock status, the campaign and keyword reports) is persisted to memory with spill
to disk, so that it is computed once; lost blocks are recomputed from the source.
Use a bundle as a context manager to release that storage after writing, or build it
with ``share=False``, which persists nothing. With ``one_pass`` the facts are read once, when the
bundle is built, into a base that all tabs then read (see ``bases``).
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta
from decimal import Decimal
from functools import reduce

from pyspark import StorageLevel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfmetrics.functions.days import Day, as_date, month_days
from shelfmetrics.operators import advertising, dashboard, inventory, sales
from shelfmetrics.plans import bases

DEFAULT_TARGET = 500_000_000  # fixed value


@dataclass
class Report:
    """Tabs by name, their localised titles and headers, and the period they cover.

    ``keys`` names the columns that tell a tab's rows apart; a tab of one row has none.
    """

    name: str
    period: str
    tabs: dict[str, DataFrame]
    titles: dict[str, str]
    headers: dict[str, list[str]] = field(default_factory=dict)
    keys: dict[str, list[str]] = field(default_factory=dict)
    shared: list[DataFrame] = field(default_factory=list)

    def __enter__(self) -> Report:
        return self

    def __exit__(self, *_) -> None:
        self.release()

    def release(self) -> None:
        for df in self.shared:
            df.unpersist()


def _share(df: DataFrame, share: bool) -> DataFrame:
    return df.persist(StorageLevel.MEMORY_AND_DISK) if share else df


def tab_row_counts(report: Report) -> DataFrame:
    """Rows per tab, counted in one job."""
    counts = [
        df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(tab).alias("tab"), "row_count")
        for tab, df in report.tabs.items()
    ]
    return reduce(DataFrame.unionByName, counts)


def tab_cells(report: Report) -> DataFrame:
    """Every cell of every tab: tab, row key, header, and the value as text or as a double.

    The row key is a JSON array of the key columns. Where several rows of a tab share it (the
    urgent SKUs of more than one warehouse), only one other column is left to tell them apart.
    """
    return reduce(
        DataFrame.unionByName,
        [
            _cells(tab, df, report.keys.get(tab, []), report.headers.get(tab, df.columns))
            for tab, df in report.tabs.items()
        ],
    )


def _cells(tab: str, df: DataFrame, keys: list[str], header: list[str]) -> DataFrame:
    key = F.array(*[F.col(k).cast("string") for k in keys]).cast("array<string>")
    cells = []
    for kept, name in zip(df.schema.fields, header, strict=True):
        value = F.col(kept.name)
        double = isinstance(kept.dataType, T.DoubleType)
        text = F.lit(None) if double else value
        number = value if double else F.lit(None)
        cells.append(
            F.struct(
                F.lit(name).alias("header"),
                text.cast("string").alias("text"),
                number.cast("double").alias("number"),
            )
        )
    return df.select(
        F.lit(tab).alias("tab"), F.to_json(key).alias("row_key"), F.inline(F.array(*cells))
    )


# Tab titles and header rows of the spreadsheets.

TITLE_DAILY, TITLE_TOP, TITLE_MONTH, TITLE_STOCK = "일간매출", "베스트셀러", "매출요약", "재고현황"
TITLE_ADS, TITLE_SUMMARY, TITLE_URGENT = "광고성과", "요약", "긴급 상품 목록"
TITLE_CAMPAIGNS, TITLE_DEFICIT, TITLE_SPEND = "캠페인ROAS", "적자캠페인", "광고효율추이"
TITLE_KEYWORDS, TITLE_STOP, TITLE_WEEKLY = "키워드성과", "중단 검토 키워드", "주간추이"

HEADER_MONTH = [
    "채널", "카테고리", "당월 주문수", "당월 매출", "당월 이익", "당월 GPM%",
    "전년 주문수", "전년 매출", "전년 이익", "전년 GPM%",
    "매출 YoY%", "주문 YoY%", "이익 YoY%", "목표기여율%",
]
HEADER_TOP = ["상품ID", "상품명", "SKU", "판매수량", "매출", "주문수", "평균단가", "GPM%"]
HEADER_STOCK = ["SKU", "상품명", "창고", "현재재고", "일평균판매", "잔여일수", "상태"]
HEADER_ADS = [
    "캠페인ID", "캠페인명", "플랫폼", "노출수", "클릭수", "CTR%",
    "광고비", "기여매출", "ROAS", "주문수", "CPA", "효율등급",
]
HEADER_SUMMARY = ["항목", "값"]

_TOP_KEY = ["product_id", "product_name", "sku"]
_CAMPAIGN_KEY = ["campaign_id", "campaign_name", "platform"]
_KEYWORD_KEY = ["keyword", "match_type", "campaign_name", "platform"]


def daily_sales_report(orders: DataFrame, day: Day, one_pass: bool = False) -> Report:
    day = as_date(day)
    if one_pass:
        orders = bases.line_base(orders, [(day, day)])
    return Report(
        name="daily_sales",
        period=f"{day}",
        tabs={
            "daily_sales": sales.daily_sales_summary(orders, day),
            "top_sellers": sales.top_sellers(orders, day, day, 10),
        },
        titles={"daily_sales": TITLE_DAILY, "top_sellers": TITLE_TOP},
        keys={"daily_sales": ["sale_date", "channel", "category"], "top_sellers": _TOP_KEY},
    )


def weekly_inventory_alert(
    stock: DataFrame,
    orders: DataFrame,
    as_of: Day,
    channel: str = inventory.ROCKET,
    warehouse: str = inventory.ROCKET,
    share: bool = True,
    one_pass: bool = False,
) -> Report:
    if one_pass:
        orders = bases.demand_base(orders, as_date(as_of) - timedelta(days=30), as_of)
    status = _share(inventory.stock_status(stock, orders, as_of), share)
    risk = _share(inventory.rocket_delivery_risk(stock, orders, as_of, channel, warehouse), share)
    return Report(
        name="weekly_inventory_alert",
        period=f"{as_date(as_of)}",
        tabs={
            "summary": inventory.inventory_alert_summary(status, risk),
            "urgent_skus": inventory.urgent_sku_list(status, risk),
        },
        titles={"summary": TITLE_SUMMARY, "urgent_skus": TITLE_URGENT},
        keys={"urgent_skus": ["source", "sku", "product_name"]},
        shared=[status, risk],
    )


def monthly_business_report(
    orders: DataFrame,
    stock: DataFrame,
    ad_campaigns: DataFrame,
    month: str,
    as_of: Day,
    target: Decimal | int | float = DEFAULT_TARGET,
    share: bool = True,
    ad_month: str | None = None,
    one_pass: bool = False,
) -> Report:
    """``ad_month`` is the month of the ad tab where it is not that of the sales."""
    first, last = month_days(month)
    ad_days = month_days(month if ad_month is None else ad_month)
    if one_pass:
        until = as_date(as_of)
        orders = bases.line_base(
            orders,
            [
                (first, last),
                month_days(month, years_back=1),
                (first.replace(month=1, day=1), min(until, first.replace(month=12, day=31))),
                (until - timedelta(days=30), until),
            ],
        )
    cells = _share(sales.monthly_cells(orders, month, as_of), share)
    status = _share(inventory.stock_status(stock, orders, as_of), share)
    summary = sales.monthly_comparison_summary(orders, month, target, as_of, cells)
    counts = inventory.stock_status_counts(status)
    kpis = dashboard.monthly_kpi_dashboard(summary, counts, target)
    return Report(
        name="monthly_business",
        period=f"{first} ~ {last}",
        tabs={
            "summary": kpis.orderBy("position").drop("position"),
            "monthly_sales": sales.monthly_comparison_detail(orders, month, target, cells),
            "monthly_total": summary,
            "top_sellers": sales.top_sellers(orders, first, last, 20),
            "stock_status": status,
            "ad_performance": advertising.roas_by_campaign(ad_campaigns, *ad_days),
        },
        titles={
            "summary": TITLE_SUMMARY,
            "monthly_sales": TITLE_MONTH,
            "monthly_total": TITLE_MONTH,
            "top_sellers": TITLE_TOP,
            "stock_status": TITLE_STOCK,
            "ad_performance": TITLE_ADS,
        },
        headers={
            "summary": HEADER_SUMMARY,
            "monthly_sales": HEADER_MONTH,
            "top_sellers": HEADER_TOP,
            "stock_status": HEADER_STOCK,
            "ad_performance": HEADER_ADS,
        },
        keys={
            "summary": ["item"],
            "monthly_sales": ["channel", "category"],
            "top_sellers": _TOP_KEY,
            "stock_status": ["sku", "product_name", "warehouse"],
            "ad_performance": _CAMPAIGN_KEY,
        },
        shared=[cells, status],
    )


def ad_roas_report(
    ad_campaigns: DataFrame,
    ad_keywords: DataFrame,
    end: Day,
    start: Day | None = None,
    share: bool = True,
    one_pass: bool = False,
) -> Report:
    end: date = as_date(end)
    start = end - timedelta(days=7) if start is None else as_date(start)
    if one_pass:
        ad_campaigns = bases.ad_base(ad_campaigns, [(start, end), (end - timedelta(days=28), end)])
        ad_keywords = bases.ad_base(ad_keywords, [(start, end)])
    campaigns = _share(advertising.roas_by_campaign(ad_campaigns, start, end), share)
    keywords = _share(advertising.keyword_performance(ad_keywords, start, end), share)
    return Report(
        name="ad_roas",
        period=f"{start} ~ {end}",
        tabs={
            "campaigns": campaigns,
            "deficit_campaigns": advertising.deficit_campaigns(campaigns),
            "spend_efficiency": advertising.ad_spend_efficiency(ad_campaigns, start, end),
            "keywords": keywords,
            "stop_review_keywords": advertising.stop_review_keywords(keywords),
            "weekly_trend": advertising.weekly_ad_trend(ad_campaigns, end),
            "summary": advertising.ad_overall_summary(campaigns, keywords),
        },
        titles={
            "campaigns": TITLE_CAMPAIGNS,
            "deficit_campaigns": TITLE_DEFICIT,
            "spend_efficiency": TITLE_SPEND,
            "keywords": TITLE_KEYWORDS,
            "stop_review_keywords": TITLE_STOP,
            "weekly_trend": TITLE_WEEKLY,
            "summary": TITLE_SUMMARY,
        },
        keys={
            "campaigns": _CAMPAIGN_KEY,
            "deficit_campaigns": _CAMPAIGN_KEY,
            "spend_efficiency": ["report_date", "platform"],
            "keywords": _KEYWORD_KEY,
            "stop_review_keywords": _KEYWORD_KEY,
            "weekly_trend": ["week_start"],
        },
        shared=[campaigns, keywords],
    )
