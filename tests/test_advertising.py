from datetime import date, datetime

import pytest

from rows import AS_OF, ad_campaigns, ad_keywords, back, by, only
from shelfmetrics.operators import advertising as ops


def test_campaign_worked_example(spark):
    df = ad_campaigns(
        spark,
        dict(
            impressions=250_000, clicks=5000, ad_spend=1_500_000.0, attributed_orders=300,
            attributed_revenue=9_000_000.0,
        ),
    )
    row = only(ops.roas_by_campaign(df, AS_OF, AS_OF))
    assert (row.ctr_pct, row.roas, row.cpa, row.efficiency) == (2.0, 6.0, 5000.0, "🟢 우수")


def test_zero_measures_give_null_ratios_and_worst_grades(spark):
    zero = dict(clicks=0, ad_spend=0.0, attributed_orders=0, attributed_revenue=0.0, impressions=0)
    row = only(ops.roas_by_campaign(ad_campaigns(spark, zero), AS_OF, AS_OF))
    assert row.ctr_pct is row.roas is row.cpa is None
    assert row.efficiency == "🔴 적자"
    row = only(ops.ad_spend_efficiency(ad_campaigns(spark, zero), AS_OF, AS_OF))
    assert row.cpc is row.cpm is row.cpa is row.cvr_pct is None
    assert row.spend_efficiency == "🔴 과다지출"
    row = only(
        ops.keyword_performance(ad_keywords(spark, {**zero, "impressions": 1}), AS_OF, AS_OF)
    )
    assert (row.keyword_grade, row.conversion_quality) == ("🔴 중단 검토", "데이터 부족")


def test_rounded_roas_lists_and_unrounded_roas_grades(spark):
    df = ad_campaigns(
        spark,
        dict(campaign_id="edge", ad_spend=1000.0, attributed_revenue=996.0),
        dict(campaign_id="poor", ad_spend=1000.0, attributed_revenue=990.0),
        dict(campaign_id="free", ad_spend=0.0),
    )
    report = ops.roas_by_campaign(df, AS_OF, AS_OF)
    edge = by(report, "campaign_id")["edge"]
    assert (edge.roas, edge.efficiency) == (1.0, "🔴 적자")
    assert [r.campaign_id for r in ops.deficit_campaigns(report).collect()] == ["poor"]


@pytest.mark.parametrize(
    "revenue, label",
    [(5000.0, "🟢 우수"), (4999.0, "🟡 양호"), (3000.0, "🟡 양호"), (2999.0, "🟠 주의"), (1000.0, "🟠 주의"), (999.0, "🔴 적자")],
)
def test_campaign_limits(spark, revenue, label):
    df = ad_campaigns(spark, dict(attributed_revenue=revenue))
    assert only(ops.roas_by_campaign(df, AS_OF, AS_OF)).efficiency == label


@pytest.mark.parametrize(
    "spend, label",
    [(30_000.0, "🟢 고효율"), (30_001.0, "🟡 보통"), (50_000.0, "🟡 보통"), (50_001.0, "🟠 비효율"), (80_000.0, "🟠 비효율"), (80_001.0, "🔴 과다지출")],
)
def test_spend_limits(spark, spend, label):
    df = ad_campaigns(spark, dict(ad_spend=spend, attributed_orders=10))
    assert only(ops.ad_spend_efficiency(df, AS_OF, AS_OF)).spend_efficiency == label


def test_spend_days_are_calendar_days_and_gaps_are_skipped(spark):
    df = ad_campaigns(
        spark,
        dict(report_date=datetime(2026, 3, 16, 1), ad_spend=400.0),
        dict(report_date=datetime(2026, 3, 16, 23), ad_spend=601.0),
        dict(report_date=datetime(2026, 3, 19), ad_spend=1101.1, clicks=200),
    )
    days = by(ops.ad_spend_efficiency(df, "2026-03-01", AS_OF), "report_date")
    assert set(days) == {date(2026, 3, 16), date(2026, 3, 19)}
    assert (days[date(2026, 3, 16)].cpc, days[date(2026, 3, 16)].cpc_change_pct) == (5.0, None)
    # unrounded: 5.5055 against 5.005
    assert (days[date(2026, 3, 19)].cpc, days[date(2026, 3, 19)].cpc_change_pct) == (6.0, 10.0)


def test_change_after_a_day_without_clicks_is_unknown(spark):
    df = ad_campaigns(
        spark, dict(report_date=back(2)), dict(report_date=back(1), clicks=0), dict()
    )
    days = by(ops.ad_spend_efficiency(df, back(2).date(), AS_OF), "report_date")
    assert [days[back(n).date()].cpc_change_pct for n in (2, 1, 0)] == [None, None, None]


@pytest.mark.parametrize(
    "clicks, orders, label",
    [
        (100, 5, "높은 전환"), (100, 4, "보통"), (100, 1, "보통"), (101, 1, "낮은 전환"),
        (99, 99, "보통"), (10, 0, "보통"), (9, 9, "데이터 부족"),
    ],
)
def test_conversion_quality_limits(spark, clicks, orders, label):
    df = ad_keywords(spark, dict(clicks=clicks, attributed_orders=orders))
    assert only(ops.keyword_performance(df, AS_OF, AS_OF)).conversion_quality == label


def test_keywords_never_shown_are_left_out(spark):
    df = ad_keywords(spark, dict(keyword="seen"), dict(keyword="unseen", impressions=0))
    assert only(ops.keyword_performance(df, AS_OF, AS_OF)).keyword == "seen"


def test_stop_review_includes_keywords_without_spend(spark):
    df = ad_keywords(
        spark,
        dict(keyword="free", ad_spend=0.0),
        dict(keyword="poor", attributed_revenue=999.0),
        dict(keyword="fine"),
    )
    report = ops.keyword_performance(df, AS_OF, AS_OF)
    assert {r.keyword for r in ops.stop_review_keywords(report).collect()} == {"free", "poor"}


def test_weekly_trend_window(spark):
    df = ad_campaigns(
        spark, dict(report_date=back(28)), dict(report_date=back(29)), dict(report_date=back(-1)), {}
    )
    weeks = by(ops.weekly_ad_trend(df, AS_OF), "week_start")
    assert {k: v.weekly_spend for k, v in weeks.items()} == {
        date(2026, 2, 16): 1000.0,
        date(2026, 3, 16): 1000.0,
    }
    assert weeks[date(2026, 3, 16)].weekly_cvr_pct == 10.0


def test_overall_summary(spark):
    campaigns = ops.roas_by_campaign(
        ad_campaigns(spark, dict(campaign_id="a", attributed_revenue=10.1), dict(campaign_id="b")),
        AS_OF,
        AS_OF,
    )
    keywords = ops.keyword_performance(
        ad_keywords(spark, dict(keyword="x", ad_spend=0.0), dict(keyword="y")), AS_OF, AS_OF
    )
    row = only(ops.ad_overall_summary(campaigns, keywords))
    assert (row.campaign_count, row.total_spend, row.total_revenue) == (2, 2000.0, 5010.1)
    assert (row.overall_roas, row.deficit_count, row.stop_keyword_count) == (2.51, 1, 1)


def test_overall_roas_is_zero_without_spend(spark):
    campaigns = ops.roas_by_campaign(ad_campaigns(spark, dict(ad_spend=0.0)), AS_OF, AS_OF)
    keywords = ops.keyword_performance(ad_keywords(spark), AS_OF, AS_OF)
    assert only(ops.ad_overall_summary(campaigns, keywords)).overall_roas == 0.0
    nothing = ops.roas_by_campaign(ad_campaigns(spark), AS_OF, AS_OF)
    row = only(ops.ad_overall_summary(nothing, keywords))
    assert (row.campaign_count, row.total_spend, row.overall_roas) == (0, 0.0, 0.0)
