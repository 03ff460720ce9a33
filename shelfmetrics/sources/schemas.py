"""Declared schemas: the four tables the reports read and the documented ones.

Fixed values: table names, column names, order, types and modes.
"""

from __future__ import annotations

from pyspark.sql import types as T

STRING, LONG, DOUBLE = T.StringType(), T.LongType(), T.DoubleType()
BOOLEAN, DATE = T.BooleanType(), T.DateType()
TIMESTAMP, LOCAL_TIMESTAMP = T.TimestampType(), T.TimestampNTZType()
NUMERIC, MONEY = T.DecimalType(38, 9), T.DecimalType(28, 8)
REQUIRED = "REQUIRED"


def _table(*columns: tuple) -> T.StructType:
    """Columns as (name, type), or (name, type, REQUIRED)."""
    return T.StructType([T.StructField(c[0], c[1], nullable=REQUIRED not in c[2:]) for c in columns])


# The tables the reports read.

REPORT_TABLES: dict[str, T.StructType] = {
    "orders": _table(
        ("order_id", STRING),
        ("order_date", LOCAL_TIMESTAMP),
        ("channel", STRING),
        ("category", STRING),
        ("product_id", STRING),
        ("product_name", STRING),
        ("sku", STRING),
        ("quantity", LONG),
        ("revenue", MONEY),
        ("cost", MONEY),
        ("unit_price", DOUBLE),
        ("unit_cost", DOUBLE),
    ),
    "inventory": _table(
        ("sku", STRING),
        ("product_name", STRING),
        ("warehouse", STRING),
        ("current_stock", LONG),
    ),
    "ad_campaigns": _table(
        ("campaign_id", STRING),
        ("campaign_name", STRING),
        ("platform", STRING),
        ("report_date", LOCAL_TIMESTAMP),
        ("impressions", LONG),
        ("clicks", LONG),
        ("ad_spend", MONEY),
        ("attributed_orders", LONG),
        ("attributed_revenue", MONEY),
    ),
    "ad_keywords": _table(
        ("keyword", STRING),
        ("match_type", STRING),
        ("campaign_name", STRING),
        ("platform", STRING),
        ("report_date", LOCAL_TIMESTAMP),
        ("impressions", LONG),
        ("clicks", LONG),
        ("ad_spend", MONEY),
        ("attributed_orders", LONG),
        ("attributed_revenue", MONEY),
    ),
}


# Documented tables that no report reads.

DOCUMENTED_TABLES: dict[str, T.StructType] = {
    "ca_brands": _table(
        ("snapshot_date", DATE, REQUIRED),
        ("period", LONG),
        ("category", STRING),
        ("rank", LONG),
        ("brand", STRING),
        ("search_exposure", DOUBLE),
        ("search_exposure_change", DOUBLE),
        ("clicks", DOUBLE),
        ("clicks_change", DOUBLE),
        ("click_rate", DOUBLE),
        ("click_rate_change", DOUBLE),
    ),
    "ca_product_keywords": _table(
        ("snapshot_date", DATE, REQUIRED),
        ("period", LONG),
        ("category", STRING),
        ("product_id", STRING),
        ("product_rank", LONG),
        ("keyword", STRING),
        ("search_volume", DOUBLE),
        ("search_volume_change", DOUBLE),
        ("search_exposure", DOUBLE),
        ("search_exposure_change", DOUBLE),
        ("clicks", DOUBLE),
        ("clicks_change", DOUBLE),
    ),
    "ca_products": _table(
        ("snapshot_date", DATE, REQUIRED),
        ("period", LONG),
        ("category", STRING),
        ("rank", LONG),
        ("product_name", STRING),
        ("product_id", STRING),
        ("release_date", STRING),
        ("rating", DOUBLE),
        ("review_count", LONG),
        ("search_exposure", DOUBLE),
        ("search_exposure_change", DOUBLE),
        ("clicks", DOUBLE),
        ("clicks_change", DOUBLE),
        ("click_rate", DOUBLE),
        ("click_rate_change", DOUBLE),
    ),
    "cp_coupon_funding": _table(
        ("date", DATE),
        ("contract_no", LONG),
        ("sku_id", LONG),
        ("daily_funding", NUMERIC),
        ("created_at", TIMESTAMP),
    ),
    "cp_nca": _table(
        ("date", DATE),
        ("campaign_id", LONG),
        ("campaign_name", STRING),
        ("campaign_start", STRING),
        ("campaign_end", STRING),
        ("operation_type", STRING),
        ("ad_id", LONG),
        ("ad_name", STRING),
        ("ad_product_name", STRING),
        ("creative", STRING),
        ("ad_option_id", LONG),
        ("exposure_area", STRING),
        ("keyword", STRING),
        ("impressions", LONG),
        ("clicks", LONG),
        ("video_3s_view", LONG),
        ("engagements", LONG),
        ("ad_cost", LONG),
        ("first_purchase_revenue", LONG),
    ),
    "cp_nca_ad": _table(
        ("date", DATE, REQUIRED),
        ("campaign_id", LONG),
        ("campaign_name", STRING),
        ("ad_id", LONG),
        ("ad_name", STRING),
        ("ad_product_name", STRING),
        ("creative", STRING),
        ("ad_option_id", LONG),
        ("new_customer_count", LONG),
        ("cost_per_new_customer", DOUBLE),
    ),
    "cp_pa": _table(
        ("date", DATE),
        ("ad_type", STRING),
        ("campaign_id", LONG),
        ("campaign_name", STRING),
        ("ad_group", STRING),
        ("ad_product_name", STRING),
        ("ad_option_id", LONG),
        ("conv_product_name", STRING),
        ("conv_option_id", LONG),
        ("exposure_area", STRING),
        ("retargeting", STRING),
        ("impressions", LONG),
        ("clicks", LONG),
        ("ad_cost", LONG),
        ("total_orders_1d", LONG),
        ("direct_orders_1d", LONG),
        ("indirect_orders_1d", LONG),
        ("total_sales_qty_1d", LONG),
        ("direct_sales_qty_1d", LONG),
        ("indirect_sales_qty_1d", LONG),
        ("total_conv_revenue_1d", LONG),
        ("direct_conv_revenue_1d", LONG),
        ("indirect_conv_revenue_1d", LONG),
        ("total_orders_14d", LONG),
        ("direct_orders_14d", LONG),
        ("indirect_orders_14d", LONG),
        ("total_sales_qty_14d", LONG),
        ("direct_sales_qty_14d", LONG),
        ("indirect_sales_qty_14d", LONG),
        ("total_conv_revenue_14d", LONG),
        ("direct_conv_revenue_14d", LONG),
        ("indirect_conv_revenue_14d", LONG),
        ("campaign_start", STRING),
        ("campaign_end", STRING),
    ),
    "cp_products": _table(
        ("barcode", STRING),
        ("sku_id", LONG),
        ("sku_name", STRING),
        ("vendor_item_name", STRING),
        ("rocket_fresh", STRING),
        ("product_category", STRING),
        ("sub_category", STRING),
        ("detail_category", STRING),
        ("brand", STRING),
        ("created_at", TIMESTAMP),
        ("updated_at", TIMESTAMP),
        ("product_id", LONG),
        ("vendor_item_id", LONG),
        ("combo_model", STRING),
        ("order_status", STRING),
        ("commerce_status", STRING),
    ),
    "cp_reviewer_funding": _table(
        ("date", DATE, REQUIRED),
        ("sku_id", LONG, REQUIRED),
        ("quantity", LONG),
        ("funding_cost", LONG),
        ("sample_supply_cost", LONG),
        ("total_cost", LONG),
    ),
    "daily_performance": _table(
        ("date", DATE),
        ("barcode", STRING),
        ("sku_name", STRING),
        ("vendor_item_name", STRING),
        ("rocket_fresh", STRING),
        ("product_category", STRING),
        ("sub_category", STRING),
        ("detail_category", STRING),
        ("brand", STRING),
        ("gmv", DOUBLE),
        ("units_sold", LONG),
        ("return_units", LONG),
        ("cogs", DOUBLE),
        ("amv", DOUBLE),
        ("coupon_discount", DOUBLE),
        ("coupang_extra_discount", DOUBLE),
        ("instant_discount", DOUBLE),
        ("promo_gmv", DOUBLE),
        ("promo_units_sold", LONG),
        ("asp", DOUBLE),
        ("order_count", LONG),
        ("customer_count", LONG),
        ("aov", DOUBLE),
        ("conversion_rate", DOUBLE),
        ("pv", LONG),
        ("sns_gmv", DOUBLE),
        ("sns_cogs", DOUBLE),
        ("sns_ratio", DOUBLE),
        ("sns_units_sold", LONG),
        ("sns_return_units", LONG),
        ("review_count", LONG),
        ("avg_rating", DOUBLE),
        ("premium_cost", DOUBLE),
        ("product_id", LONG),
        ("sku_id", LONG),
        ("vendor_item_id", LONG),
    ),
    "ext_db_skuid": _table(
        ("sku_id", STRING),
        ("sku_name", STRING),
    ),
    "ext_ops_status": _table(
        ("category_1", STRING),
        ("device_type", STRING),
        ("model_lineup", STRING),
        ("combo_model", STRING),
        ("sku_code", STRING),
        ("material_name", STRING),
        ("commerce_status", STRING),
        ("sku_id", STRING),
        ("order_status", STRING),
        ("product_id", STRING),
        ("vendor_item_id", STRING),
        ("combo_match", STRING),
        ("coupang_product_name", STRING),
        ("batch_stock", STRING),
        ("available_stock", STRING),
        ("coupang_stock", STRING),
        ("product_category", STRING),
        ("sub_category", STRING),
        ("detail_category", STRING),
        ("barcode", STRING),
    ),
    "keyword_rankings": _table(
        ("execution_time", TIMESTAMP),
        ("project", STRING),
        ("keyword", STRING),
        ("list_order", LONG),
        ("rank", LONG),
        ("is_ad", BOOLEAN),
        ("product_name", STRING),
        ("discount_price", LONG),
        ("original_price", LONG),
        ("discount_rate", LONG),
        ("rating", DOUBLE),
        ("review_count", LONG),
        ("delivery_type", STRING),
        ("is_cou_pick", BOOLEAN),
        ("product_id", STRING),
        ("vendor_item_id", STRING),
        ("product_url", STRING),
        ("is_our_product", BOOLEAN),
    ),
    "rocket_metrics": _table(
        ("date", DATE),
        ("product_category", STRING),
        ("sub_category", STRING),
        ("detail_category", STRING),
        ("brand", STRING),
        ("center", STRING),
        ("sku_name", STRING),
        ("barcode", STRING),
        ("order_available_status", STRING),
        ("order_available_status_detail", STRING),
        ("inbound_qty", LONG),
        ("outbound_qty", LONG),
        ("current_stock_qty", LONG),
        ("cogs", DOUBLE),
        ("order_delivery_rate", DOUBLE),
        ("confirmed_delivery_rate", DOUBLE),
        ("return_rate", DOUBLE),
        ("return_reason", STRING),
        ("out_of_stock", STRING),
        ("detail_category_oos_rate", DOUBLE),
        ("sku_id", LONG),
    ),
}

SHEET_TABLES = ("ext_db_skuid", "ext_ops_status")

SCHEMAS: dict[str, T.StructType] = {**REPORT_TABLES, **DOCUMENTED_TABLES}
