"""Advertising reports over campaign and keyword facts."""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, as_date, in_days, week_start
from shelfmetrics.functions.labels import (
    CAMPAIGN_EFFICIENCY,
    KEYWORD_GRADE,
    KEYWORD_STOP_MARK,
    SPEND_EFFICIENCY,
    conversion_quality,
    grade,
)
from shelfmetrics.functions.metrics import (
    change_pct,
    money_sum,
    pct,
    round_half_away,
    safe_div,
)


def _totals(facts: DataFrame, *keys: str) -> DataFrame:
    """Sums of the five ad measures per key, plus unrounded ROAS and cost per order."""
    return (
        facts.groupBy(*keys)
        .agg(
            F.sum("impressions").alias("impressions"),
            F.sum("clicks").alias("clicks"),
            F.sum("attributed_orders").alias("orders"),
            money_sum("ad_spend").alias("spend"),
            money_sum("attributed_revenue").alias("revenue"),
        )
        .withColumn("return", safe_div("revenue", "spend"))
        .withColumn("order_cost", safe_div("spend", "orders"))
    )


def roas_by_campaign(ad_campaigns: DataFrame, start: Day, end: Day) -> DataFrame:
    """Reach, spend, return and efficiency grade per campaign and platform."""
    keys = ["campaign_id", "campaign_name", "platform"]
    return (
        _totals(ad_campaigns.where(in_days("report_date", start, end)), *keys)
        .select(
            *keys,
            "impressions",
            "clicks",
            pct("clicks", "impressions", 2).alias("ctr_pct"),
            F.col("spend").alias("total_spend"),
            F.col("revenue").alias("attributed_revenue"),
            round_half_away("return", 2).alias("roas"),
            "orders",
            round_half_away("order_cost").alias("cpa"),
            grade(F.col("return"), CAMPAIGN_EFFICIENCY).alias("efficiency"),
        )
        .orderBy(F.desc("total_spend"), *keys)
    )


def ad_spend_efficiency(ad_campaigns: DataFrame, start: Day, end: Day) -> DataFrame:
    """Cost per click, mille and order per day and platform, with the click-cost change.

    The change compares with the platform's previous day that has rows. The window
    only sees one row per day of the requested range and platform.
    """
    by_day = Window.partitionBy("platform").orderBy("report_date")
    facts = ad_campaigns.where(in_days("report_date", start, end)).withColumn(
        "report_date", F.to_date("report_date")
    )
    return (
        _totals(facts, "report_date", "platform")
        .withColumn("click_cost", safe_div("spend", "clicks"))
        .withColumn("previous", F.lag("click_cost").over(by_day))
        .select(
            "report_date",
            "platform",
            F.col("spend").alias("daily_spend"),
            "impressions",
            "clicks",
            "orders",
            round_half_away("click_cost").alias("cpc"),
            round_half_away(safe_div("spend", "impressions") * 1000).alias("cpm"),
            round_half_away("order_cost").alias("cpa"),
            pct("clicks", "impressions", 2).alias("ctr_pct"),
            pct("orders", "clicks", 2).alias("cvr_pct"),
            round_half_away("return", 2).alias("roas"),
            change_pct("click_cost", "previous").alias("cpc_change_pct"),
            grade(F.col("order_cost"), SPEND_EFFICIENCY).alias("spend_efficiency"),
        )
        .orderBy(F.desc("report_date"), "platform")
    )


def keyword_performance(ad_keywords: DataFrame, start: Day, end: Day) -> DataFrame:
    """Clicks, conversions, return and two grades per keyword that was shown at all."""
    keys = ["keyword", "match_type", "campaign_name", "platform"]
    return (
        _totals(ad_keywords.where(in_days("report_date", start, end)), *keys)
        .where(F.col("impressions") > 0)
        .select(
            *keys,
            "impressions",
            "clicks",
            pct("clicks", "impressions", 2).alias("ctr_pct"),
            F.col("spend").alias("keyword_spend"),
            round_half_away(safe_div("spend", "clicks")).alias("cpc"),
            F.col("orders").alias("conversions"),
            pct("orders", "clicks", 2).alias("cvr_pct"),
            "revenue",
            round_half_away("return", 2).alias("roas"),
            round_half_away("order_cost").alias("cpa"),
            grade(F.col("return"), KEYWORD_GRADE).alias("keyword_grade"),
            conversion_quality(F.col("clicks"), safe_div("orders", "clicks")).alias(
                "conversion_quality"
            ),
        )
        .orderBy(F.desc("keyword_spend"), *keys)
    )


def weekly_ad_trend(ad_campaigns: DataFrame, end: Day) -> DataFrame:
    """Monday-week totals of the 28 days before ``end`` and of ``end`` itself."""
    end = as_date(end)
    facts = ad_campaigns.where(in_days("report_date", end - timedelta(days=28), end))
    return (
        _totals(facts.withColumn("week_start", week_start("report_date")), "week_start")
        .select(
            "week_start",
            F.col("spend").alias("weekly_spend"),
            F.col("revenue").alias("weekly_revenue"),
            round_half_away("return", 2).alias("weekly_roas"),
            F.col("orders").alias("weekly_orders"),
            round_half_away("order_cost").alias("weekly_cpa"),
            pct("clicks", "impressions", 2).alias("weekly_ctr_pct"),
            pct("orders", "clicks", 2).alias("weekly_cvr_pct"),
        )
        .orderBy(F.desc("week_start"))
    )


def deficit_campaigns(campaigns: DataFrame) -> DataFrame:
    """Campaign report rows whose printed (rounded) ROAS is below 1, biggest spend first."""
    return campaigns.where(F.col("roas") < 1).orderBy(
        F.desc("total_spend"), "campaign_id", "campaign_name", "platform"
    )


def stop_review_keywords(keywords: DataFrame) -> DataFrame:
    """Keyword report rows graded for a stop review."""
    return keywords.where(F.col("keyword_grade").contains(KEYWORD_STOP_MARK))


def ad_overall_summary(campaigns: DataFrame, keywords: DataFrame) -> DataFrame:
    """One row over the campaign and keyword reports; overall ROAS is 0 without spend."""

    def total(column: str):
        # the declared money type has eight decimals; NaN and infinity are no money
        exact = F.try_sum(F.col(column).try_cast("decimal(38,8)")).cast("double")
        return F.coalesce(exact, F.lit(0.0))

    to_stop = keywords.agg(
        F.count_if(F.col("keyword_grade").contains(KEYWORD_STOP_MARK))
    ).scalar()
    overall = F.when(
        F.col("total_spend") > 0,
        round_half_away(safe_div("total_revenue", "total_spend"), 2),
    ).otherwise(F.lit(0.0))
    return (
        campaigns.agg(
            F.count(F.lit(1)).alias("campaign_count"),
            total("total_spend").alias("total_spend"),
            total("attributed_revenue").alias("total_revenue"),
            F.count_if(F.col("roas") < 1).alias("deficit_count"),
        )
        .withColumn("overall_roas", overall)
        .withColumn("stop_keyword_count", to_stop)
    )
