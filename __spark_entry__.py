
from __future__ import annotations

import os
import sys
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from oracle.statements import statements  # noqa: E402
from shelfmetrics.operators import (  # noqa: E402
    advertising,
    dashboard,
    funding,
    inventory,
    product,
    profile,
    sales,
)
from shelfmetrics import scratch  # noqa: E402
from shelfmetrics.functions import quantiles  # noqa: E402
from shelfmetrics.functions.days import in_days  # noqa: E402
from shelfmetrics.functions.daysets import day_sets  # noqa: E402
from shelfmetrics.functions.positions import with_position  # noqa: E402
from shelfmetrics.plans import bundles  # noqa: E402
from shelfmetrics.sinks import files, publish  # noqa: E402
from shelfmetrics.sources import catalogue, sheets, tpch  # noqa: E402
from shelfmetrics.sources.tables import read_table  # noqa: E402

# the training-data operators and their pipeline may be left out as a whole
try:
    import corpus_pipeline
    from shelfmetrics.llm import queries as training_data
except ModuleNotFoundError as missing:
    if missing.name != "corpus_pipeline" and not str(missing.name).startswith("shelfmetrics.llm"):
        raise
    training_data = None

DAY = "2001-03-15"
AS_OF = "2001-07-31"
MONTH, TARGET = "2001-03", 50_000_000
MONTH_START, MONTH_END = "2001-03-01", "2001-03-31"
CHANNEL, WAREHOUSE = "BUILDING", "ASIA"
AD_START, AD_END = "2024-01-05", "2024-01-12"
ADS_FIRST, ADS_LAST = "2024-01-01", "2024-01-30"
AD_MONTH = "2024-01"
GENERATED_AT = "2001-08-01 09:00:00"
DAYS_FIRST = "2001-07-02"
QUARTER = ("2001-03-01", "2001-05-31")

PROFILED = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey", "o_custkey"],
    "lineitem": ["l_orderkey", "l_partkey", "l_linenumber"],
    "events": ["event_id", "ts"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}


def entry(spark: SparkSession) -> DataFrame:
    """Month against last year's month, on the smallest test data."""
    return queries()["monthly_comparison_detail"](spark, "/root/testdata/sf0.001")


def _daily_sales_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.daily_sales_summary(tpch.order_lines(spark, sf_dir), DAY)


def _weekly_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.weekly_trend(tpch.order_lines(spark, sf_dir), AS_OF)


def _monthly_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_comparison_detail(tpch.order_lines(spark, sf_dir), MONTH, TARGET)


def _monthly_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sales.monthly_comparison_summary(tpch.order_lines(spark, sf_dir), MONTH, TARGET, AS_OF)


def _ytd_revenue(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tpch.order_lines(spark, sf_dir, customers=False, parts=False)
    return sales.ytd_revenue_by_month(lines, int(MONTH[:4]), AS_OF)


def _top_sellers(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = tpch.order_lines(spark, sf_dir, customers=False)
    return sales.top_sellers(lines, MONTH_START, MONTH_END, 20)


def _stock_and_lines(
    spark: SparkSession, sf_dir: str, customers: bool = False
) -> tuple[DataFrame, DataFrame]:
    return tpch.inventory(spark, sf_dir), tpch.order_lines(spark, sf_dir, customers=customers)


def _stock_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.stock_status(*_stock_and_lines(spark, sf_dir), AS_OF)


def _depletion_forecast(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.depletion_forecast(*_stock_and_lines(spark, sf_dir), AS_OF)


def _reorder_alert(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.reorder_alert(*_stock_and_lines(spark, sf_dir), AS_OF)


def _rocket_delivery_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    tables = _stock_and_lines(spark, sf_dir, customers=True)
    return inventory.rocket_delivery_risk(*tables, AS_OF, CHANNEL, WAREHOUSE)


def _stock_status_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.stock_status_counts(_stock_status(spark, sf_dir))


def _urgent_sku_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.urgent_sku_list(
        _stock_status(spark, sf_dir), _rocket_delivery_risk(spark, sf_dir)
    )


def _inventory_alert_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.inventory_alert_summary(
        _stock_status(spark, sf_dir), _rocket_delivery_risk(spark, sf_dir)
    )


def _roas_by_campaign(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.roas_by_campaign(tpch.ad_campaigns(spark, sf_dir), AD_START, AD_END)


def _ad_spend_efficiency(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.ad_spend_efficiency(tpch.ad_campaigns(spark, sf_dir), ADS_FIRST, ADS_LAST)


def _keywords(
    spark: SparkSession, sf_dir: str, start: str = ADS_FIRST, end: str = ADS_LAST
) -> DataFrame:
    return advertising.keyword_performance(tpch.ad_keywords(spark, sf_dir), start, end)


def _weekly_ad_trend(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.weekly_ad_trend(tpch.ad_campaigns(spark, sf_dir), ADS_LAST)


def _deficit_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.deficit_campaigns(_roas_by_campaign(spark, sf_dir))


def _stop_review_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.stop_review_keywords(_keywords(spark, sf_dir))


def _ad_overall_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return advertising.ad_overall_summary(
        _roas_by_campaign(spark, sf_dir), _keywords(spark, sf_dir, AD_START, AD_END)
    )


def _gpm_analysis(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.gpm_analysis(tpch.order_lines(spark, sf_dir), MONTH_START, MONTH_END)


def _price_query(operator) -> Callable[[SparkSession, str], DataFrame]:
    """A price report on its own product base, which it reads more than once."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        lines = tpch.order_lines(spark, sf_dir)
        base = scratch.written(product.product_prices(lines, MONTH_START, MONTH_END), "product-prices")
        return operator(lines, MONTH_START, MONTH_END, base)

    return run


def _quantile_rows(*args) -> DataFrame:
    """Category price statistics with the quantile array unfolded."""
    stats = product.category_price_stats(*args)
    return stats.select(
        *[c for c in stats.columns if c != "price_quantiles"],
        F.posexplode("price_quantiles").alias("percentile", "quantile_price"),
    )


def _monthly_kpi_dashboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dashboard.monthly_kpi_dashboard(
        _monthly_summary(spark, sf_dir), _stock_status_counts(spark, sf_dir), TARGET
    )


def _reviewer_funding_costs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return funding.reviewer_funding_costs(
        tpch.reviewer_funding(spark, sf_dir), tpch.supply_price(spark, sf_dir)
    )


def _table_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    profiles = None
    for name, required in PROFILED.items():
        df = tpch.table(spark, sf_dir, name)
        schema = T.StructType(
            [T.StructField(f.name, f.dataType, f.name not in required) for f in df.schema]
        )
        one = profile.table_profile(df, name, schema)
        profiles = one if profiles is None else profiles.unionByName(one)
    return profiles


def _daily_report(spark: SparkSession, sf_dir: str, one_pass: bool = False) -> bundles.Report:
    return bundles.daily_sales_report(tpch.order_lines(spark, sf_dir), DAY, one_pass=one_pass)


def _inventory_report(spark: SparkSession, sf_dir: str, one_pass: bool = False) -> bundles.Report:
    tables = _stock_and_lines(spark, sf_dir, customers=True)
    return bundles.weekly_inventory_alert(
        *tables, AS_OF, CHANNEL, WAREHOUSE, share=False, one_pass=one_pass
    )


def _monthly_report(spark: SparkSession, sf_dir: str, one_pass: bool = False) -> bundles.Report:
    stock, lines = _stock_and_lines(spark, sf_dir, customers=True)
    campaigns = tpch.ad_campaigns(spark, sf_dir)
    return bundles.monthly_business_report(
        lines, stock, campaigns, MONTH, AS_OF, TARGET, share=False, ad_month=AD_MONTH, one_pass=one_pass
    )


def _ad_report(spark: SparkSession, sf_dir: str, one_pass: bool = False) -> bundles.Report:
    return bundles.ad_roas_report(
        tpch.ad_campaigns(spark, sf_dir), tpch.ad_keywords(spark, sf_dir), AD_END,
        share=False, one_pass=one_pass,
    )


def _cells(report, **more) -> Callable[[SparkSession, str], DataFrame]:
    return lambda spark, sf_dir: bundles.tab_cells(report(spark, sf_dir, **more))


def _ranked(report, order) -> Callable[[SparkSession, str], DataFrame]:
    """A report's rows with their place in its order."""
    return lambda spark, sf_dir: with_position(report(spark, sf_dir), order())


def _stock_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.stock_rows(*_stock_and_lines(spark, sf_dir), AS_OF)


def _reorder_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return inventory.reorder_rows(*_stock_and_lines(spark, sf_dir), AS_OF)


def _price_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return product.price_rows(tpch.order_lines(spark, sf_dir), MONTH_START, MONTH_END)


def _published_monthly_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monthly report, published and read back by its manifest: all cells, and its stamp."""
    path = scratch.new_path(spark, "published")
    publish.publish(_monthly_report(spark, sf_dir, one_pass=True), path, GENERATED_AT)
    found = publish.read_published(spark, path)
    stamp = publish.stamp_cells(spark, found.manifest)
    return bundles.tab_cells(found.report).unionByName(stamp)


def _active_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sets per SKU and channel, as a store would keep them day by day, merged per SKU."""
    lines = tpch.order_lines(spark, sf_dir)
    return inventory.active_days(
        tpch.inventory(spark, sf_dir), day_sets(lines, ["sku", "channel"], "order_date"), AS_OF
    )


def _exported(name: str, kind: str) -> Callable[[SparkSession, str], DataFrame]:
    """A table exported, verified, and read back."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df, path = tpch.table(spark, sf_dir, name), scratch.new_path(spark, f"{name}-{kind}")
        files.export(df, path, kind)
        return files.read_export(spark, path, df.schema, kind)

    return run


def _conversations_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Turns as people might hand them in, some rows broken: those kept, and the others by reason."""
    cells = {
        c: F.coalesce(
            F.concat(F.lit('"'), F.replace(F.col(c).cast("string"), F.lit('"'), F.lit('""')), F.lit('"')),
            F.lit(""),
        )
        for c in ("conv_id", "turn", "role", "text")
    }
    fault = F.pmod(F.col("conv_id") * 7 + F.col("turn"), F.lit(11))
    row = (
        F.when(fault == 0, F.concat_ws(",", *cells.values(), F.lit("surplus")))
        .when(fault == 1, F.concat_ws(",", cells["conv_id"], cells["turn"], cells["role"]))
        .when(fault == 2, F.concat_ws(",", cells["conv_id"], F.lit("n/a"), cells["role"], cells["text"]))
        .when(fault == 3, F.concat(F.lit(","), F.concat_ws(",", cells["turn"], cells["role"], cells["text"])))
        .otherwise(F.concat_ws(",", *cells.values()))
    )
    path = scratch.new_path(spark, "sheet")
    tpch.table(spark, sf_dir, "conversations").select(row).write.text(path)
    schema = T.StructType([
        T.StructField("conv_id", T.LongType(), False), T.StructField("turn", T.LongType()),
        T.StructField("role", T.StringType()), T.StructField("text", T.StringType()),
    ])
    sheet = sheets.read_sheet_rows(spark, path, schema, header=False)
    kept = sheet.rows.select(F.lit("").alias("reason"), F.lit(1).cast("long").alias("n"), *schema.names)
    nothing = [F.lit(None).cast(f.dataType).alias(f.name) for f in schema.fields]
    broken = sheet.rejected.groupBy("reason").agg(F.count(F.lit(1)).alias("n")).select("reason", "n", *nothing)
    return kept.unionAll(broken)


def _weekend_roas(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Campaigns on weekends only, from a catalogue table by day and a calendar."""
    path = scratch.new_path(spark, "catalogue")
    dataset = path.rsplit("/", 1)[-1].replace("-", "_")
    catalogue.new_dataset(spark, dataset, path)
    catalogue.save_by_day(tpch.ad_campaigns(spark, sf_dir), dataset, "ad_campaigns", "report_date", f"{path}/ads")
    days = tpch.table(spark, sf_dir, "events").select(F.to_date("ts").alias("day")).distinct()
    days = days.withColumn("weekday", F.weekday("day"))
    days.write.option("path", f"{path}/days").saveAsTable(f"{dataset}.calendar")
    weekends = spark.table(f"{dataset}.calendar").where("weekday >= 5").select("day")
    facts = catalogue.on_days(read_table(spark, dataset, "ad_campaigns"), "report_date", weekends)
    return advertising.roas_by_campaign(facts, ADS_FIRST, ADS_LAST)


def _stock_status_daily(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The stock report as of each day of the month up to AS_OF."""
    return inventory.stock_status_daily(*_stock_and_lines(spark, sf_dir), DAYS_FIRST, AS_OF)


def _price_quantiles_of_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line prices per channel over a quarter, from stored summaries of its days, and how far
    their ranks really are from those asked for."""
    lines = tpch.order_lines(spark, sf_dir, parts=False).where(in_days("order_date", *QUARTER))
    lines = lines.select("channel", F.to_date("order_date").alias("day"), "unit_price")
    stored = scratch.written(quantiles.summaries(lines, ["day", "channel"], "unit_price", 4), "price-summaries")
    found = quantiles.quantiles(stored, ["channel"], list(range(0, 101, 5)))
    exact = with_position(lines.where("unit_price is not null"), [F.col("unit_price")], ["channel"], "place")
    exact = exact.groupBy("channel", F.col("unit_price").alias("value")).agg(
        F.min("place").alias("low"), F.max("place").alias("high")
    )
    rank = F.greatest(F.lit(1), F.ceil(F.col("percentile") * F.col("n") / 100))
    off = F.greatest(F.col("low") - rank, rank - F.col("high"), F.lit(0)).cast("long").alias("rank_error")
    return found.join(exact, ["channel", "value"]).select("channel", "percentile", "n", "value", "bound", off)


def _event_profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The profile of events with the paths inside props."""
    return profile.document_profile(tpch.table(spark, sf_dir, "events"), "events", ["props"], PROFILED["events"])


def _monthly_summary_sheet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The printed summary tab."""
    return dashboard.printed_summary(_monthly_kpi_dashboard(spark, sf_dir), MONTH, GENERATED_AT)


def report_queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {
        "daily_sales_summary": _daily_sales_summary,
        "weekly_trend": _weekly_trend,
        "monthly_comparison_detail": _monthly_detail,
        "monthly_comparison_summary": _monthly_summary,
        "ytd_revenue_by_month": _ytd_revenue,
        "top_sellers": _top_sellers,
        "stock_status": _stock_status,
        "depletion_forecast": _depletion_forecast,
        "reorder_alert": _reorder_alert,
        "rocket_delivery_risk": _rocket_delivery_risk,
        "roas_by_campaign": _roas_by_campaign,
        "ad_spend_efficiency": _ad_spend_efficiency,
        "keyword_performance": _keywords,
        "gpm_analysis": _gpm_analysis,
        "price_competitiveness": _price_query(product.price_competitiveness),
        "category_price_stats": _price_query(_quantile_rows),
        "price_bands": _price_query(product.price_bands),
        "weekly_ad_trend": _weekly_ad_trend,
        "deficit_campaigns": _deficit_campaigns,
        "stop_review_keywords": _stop_review_keywords,
        "ad_overall_summary": _ad_overall_summary,
        "stock_status_counts": _stock_status_counts,
        "urgent_sku_list": _urgent_sku_list,
        "inventory_alert_summary": _inventory_alert_summary,
        "monthly_kpi_dashboard": _monthly_kpi_dashboard,
        "reviewer_funding_costs": _reviewer_funding_costs,
        "table_profile": _table_profile,
        "daily_sales_report": _cells(_daily_report, one_pass=True),
        "daily_sales_report_cells": _cells(_daily_report),
        "weekly_inventory_alert": _cells(_inventory_report, one_pass=True),
        "weekly_inventory_alert_cells": _cells(_inventory_report),
        "monthly_business_report": _cells(_monthly_report, one_pass=True),
        "monthly_business_report_cells": _cells(_monthly_report),
        "ad_roas_report": _cells(_ad_report, one_pass=True),
        "ad_roas_report_cells": _cells(_ad_report),
        "stock_status_ranked": _ranked(_stock_rows, inventory.stock_order),
        "reorder_alert_ranked": _ranked(_reorder_rows, inventory.reorder_order),
        "price_competitiveness_ranked": _ranked(_price_rows, product.price_order),
        "published_monthly_report": _published_monthly_report,
        "active_days": _active_days,
        "exported_parts_json": _exported("part", "json"),
        "exported_parts_csv": _exported("part", "csv"),
        "exported_conversations_json": _exported("conversations", "json"),
        "exported_conversations_csv": _exported("conversations", "csv"),
        "conversations_sheet": _conversations_sheet,
        "weekend_roas": _weekend_roas,
        "stock_status_daily": _stock_status_daily,
        "price_quantiles_of_days": _price_quantiles_of_days,
        "event_profile": _event_profile,
        "monthly_summary_sheet": _monthly_summary_sheet,
    }


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    if training_data is None:
        return report_queries()
    return report_queries() | training_data.queries() | {"pipeline": corpus_pipeline.run}


def oracle_sql() -> dict[str, str]:
    return statements() | (training_data.oracle_sql() if training_data else {})
