"""Grading ladders as data, turned into one chained ``when``.

A NULL value fails every comparison and so lands on ``otherwise``.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import ge, gt, le, lt

from pyspark.sql import Column
from pyspark.sql import functions as F

_COMPARE = {"<": lt, "<=": le, ">": gt, ">=": ge}


@dataclass(frozen=True)
class Ladder:
    compare: str
    rungs: tuple[tuple[float, str], ...]
    otherwise: str

    @property
    def labels(self) -> tuple[str, ...]:
        return tuple(label for _, label in self.rungs) + (self.otherwise,)


def first_match(arms: list[tuple[Column, str]], otherwise: str) -> Column:
    first, *rest = arms
    chain = reduce(lambda acc, arm: acc.when(*arm), rest, F.when(*first))
    return chain.otherwise(F.lit(otherwise))


def grade(value: Column, ladder: Ladder, unit: Column | None = None) -> Column:
    """First rung that holds. ``unit`` scales the limits (limits relative to a mean)."""
    test = _COMPARE[ladder.compare]
    arms = [
        (test(value, F.lit(limit) if unit is None else unit * F.lit(limit)), label)
        for limit, label in ladder.rungs
    ]
    return first_match(arms, ladder.otherwise)


# Limits and label texts that every report must print as they are.

STOCK_STATUS = Ladder(
    "<", ((7.0, "🔴 긴급"), (14.0, "🟡 주의"), (30.0, "🟢 양호")), "⚪ 저회전"
)
STOCK_CRITICAL, STOCK_WARNING = "🔴 긴급", "🟡 주의"

FORECAST_STATUS = Ladder(
    "<",
    ((7.0, "🔴 7일 내 소진"), (14.0, "🟡 2주 내 소진"), (30.0, "🟢 1개월 내 소진")),
    "⚪ 여유",
)

TREND_DIRECTION = Ladder(
    ">", ((0.2, "📈 급증"), (0.0, "↗️ 증가"), (-0.2, "↘️ 감소")), "📉 급감"
)

REORDER_URGENT, REORDER_DUE, REORDER_SOON, REORDER_AMPLE = (
    "🔴 긴급발주",
    "🟡 발주필요",
    "🟢 발주임박",
    "⚪ 여유",
)

DELIVERY_RISK = Ladder(
    "<", ((3.0, "🚨 즉시 입고"), (7.0, "⚠️ 입고 필요"), (14.0, "📋 모니터링")), "✅ 안전"
)
DELIVERY_IMMEDIATE = "🚨 즉시 입고"

CAMPAIGN_EFFICIENCY = Ladder(
    ">=", ((5.0, "🟢 우수"), (3.0, "🟡 양호"), (1.0, "🟠 주의")), "🔴 적자"
)

SPEND_EFFICIENCY = Ladder(
    "<=",
    ((3000.0, "🟢 고효율"), (5000.0, "🟡 보통"), (8000.0, "🟠 비효율")),
    "🔴 과다지출",
)

KEYWORD_GRADE = Ladder(
    ">=",
    ((5.0, "🟢 핵심 키워드"), (3.0, "🟡 유지 키워드"), (1.0, "🟠 개선 필요")),
    "🔴 중단 검토",
)
KEYWORD_STOP_MARK = "중단"

CONVERSION_HIGH, CONVERSION_LOW, CONVERSION_THIN, CONVERSION_NORMAL = (
    "높은 전환",
    "낮은 전환",
    "데이터 부족",
    "보통",
)

GPM_TIER = Ladder(
    ">=", ((0.4, "🟢 고수익"), (0.25, "🟡 보통"), (0.1, "🟠 저수익")), "🔴 적자위험"
)

PRICE_TIER = Ladder(
    "<",
    ((0.7, "① 저가"), (0.9, "② 중저가"), (1.1, "③ 중간"), (1.3, "④ 중고가")),
    "⑤ 고가",
)

PRICE_BAND = Ladder(
    "<",
    (
        (0.7, "① 저가 (~70%)"),
        (0.9, "② 중저가 (70~90%)"),
        (1.1, "③ 중간 (90~110%)"),
        (1.3, "④ 중고가 (110~130%)"),
    ),
    "⑤ 고가 (130%~)",
)

PRICE_EDGE_RICH, PRICE_EDGE_THIN, PRICE_FAIR, PRICE_PREMIUM, PRICE_SLOW, PRICE_UNKNOWN = (
    "🟢 가격우위+고마진",
    "🟡 가격우위+저마진",
    "🔵 적정가격",
    "🟣 프리미엄(판매호조)",
    "🔴 고가(판매부진)",
    "⚪ 분류불가",
)

TOTAL_CHANNEL, TOTAL_CATEGORY = "** TOTAL **", "** ALL **"


# Ladders over more than one measure.


def reorder_alert_level(stock: Column, safety: Column, reorder_point: Column) -> Column:
    return first_match(
        [
            (stock <= safety, REORDER_URGENT),
            (stock <= reorder_point, REORDER_DUE),
            (stock <= reorder_point * 1.2, REORDER_SOON),
        ],
        REORDER_AMPLE,
    )


def conversion_quality(clicks: Column, conversion_rate: Column) -> Column:
    enough = clicks >= 100
    return first_match(
        [
            (enough & (conversion_rate >= 0.05), CONVERSION_HIGH),
            (enough & (conversion_rate < 0.01), CONVERSION_LOW),
            (clicks < 10, CONVERSION_THIN),
        ],
        CONVERSION_NORMAL,
    )


def competitiveness(price: Column, mean: Column, margin_pct: Column, quantity: Column) -> Column:
    low, high = mean * 0.9, mean * 1.1
    return first_match(
        [
            ((price < low) & (margin_pct >= 25), PRICE_EDGE_RICH),
            ((price < low) & (margin_pct < 25), PRICE_EDGE_THIN),
            (price.between(low, high), PRICE_FAIR),
            ((price > high) & (quantity >= 50), PRICE_PREMIUM),
            ((price > high) & (quantity < 50), PRICE_SLOW),
        ],
        PRICE_UNKNOWN,
    )
