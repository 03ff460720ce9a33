"""The four report tables as views over the star-schema test tables.

Dimension joins are left joins on unique keys: they keep every order line, so a
view may leave out a dimension that its reader does not use.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _sku(separator: str):
    return F.concat("p_brand", F.lit(separator), "p_type")


def order_lines(
    spark: SparkSession, sf_dir: str, customers: bool = True, parts: bool = True
) -> DataFrame:
    """Order lines; without ``customers`` no channel, without ``parts`` no product columns.

    The customer joins the order headers before the lines do, while the rows are few
    and the reader's day filter has already thinned them.
    """
    headers = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    if customers:
        segments = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment")
        headers = headers.join(segments, F.col("o_custkey") == F.col("c_custkey"), "left")
    lines = table(spark, sf_dir, "lineitem").join(
        headers, F.col("l_orderkey") == F.col("o_orderkey")
    )
    units = F.col("l_quantity").cast("bigint")
    gross = F.col("l_extendedprice").cast("decimal(18,2)")
    columns = {
        # As text: counting orders must not inherit the join's partitioning by order key,
        # which would leave all lines of a huge order in one task.
        "order_id": F.col("l_orderkey").cast("string"),
        "order_date": F.col("o_orderdate"),
        "quantity": units,
        "revenue": gross * (1 - F.col("l_discount").cast("decimal(4,2)")),
        "unit_price": F.try_divide("l_extendedprice", "l_quantity"),
    }
    if customers:
        columns["channel"] = F.col("c_mktsegment")
    if parts:
        catalogue = table(spark, sf_dir, "part")
        lines = lines.join(catalogue, F.col("l_partkey") == F.col("p_partkey"), "left")
        columns |= {
            "category": F.col("p_type"),
            "product_id": F.col("p_partkey").cast("string"),
            "sku": _sku("-"),
            "product_name": _sku(" "),
            "cost": F.col("p_retailprice").cast("decimal(18,2)") * units.cast("decimal(10,0)"),
            "unit_cost": F.col("p_retailprice"),
        }
    return lines.select(*[value.alias(name) for name, value in columns.items()])


def inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One stock row per SKU and region, as the test data define it.

    Sizes are summed per SKU first; each SKU then lists the keys that the region table has, so
    the rows made are the rows kept, however the keys are spread.
    """
    region = table(spark, sf_dir, "region")
    keys = region.agg(F.sort_array(F.collect_set("r_regionkey"))).scalar()
    sizes = (
        table(spark, sf_dir, "part")
        .groupBy("p_brand", "p_type")
        .agg(F.sum("p_size").alias("size"))
        .withColumn("r_regionkey", F.explode(keys))
    )
    return sizes.join(region, "r_regionkey").select(
        _sku("-").alias("sku"),
        _sku(" ").alias("product_name"),
        F.col("r_name").alias("warehouse"),
        (F.col("size") * (F.col("r_regionkey") + 1) * 7 % 900).cast("bigint").alias("current_stock"),
    )


def _event_money(**rate: int):
    """``value`` times the rate of the row's event type, 0 for other types."""
    value = F.col("value").cast("decimal(18,2)")
    amount = F.lit(0).cast("decimal(18,2)")
    for kind, factor in rate.items():
        amount = F.when(F.col("event_type") == kind, value * factor).otherwise(amount)
    return amount


def _event_count(kind: str, each: int):
    return F.when(F.col("event_type") == kind, each).otherwise(0).cast("bigint")


def _ad_facts(spark: SparkSession, sf_dir: str, **keys) -> DataFrame:
    columns = {
        **keys,
        "campaign_name": F.concat(F.lit("campaign_"), F.col("user_id") % 20),
        "platform": F.concat(F.lit("platform_"), F.col("user_id") % 3),
        "report_date": F.col("ts"),
        "impressions": _event_count("view", 1000),
        "clicks": _event_count("click", 40),
        "ad_spend": _event_money(click=100, error=20),
        "attributed_orders": _event_count("purchase", 1),
        "attributed_revenue": _event_money(purchase=300),
    }
    events = table(spark, sf_dir, "events")
    return events.select(*[value.alias(name) for name, value in columns.items()])


def ad_campaigns(spark: SparkSession, sf_dir: str) -> DataFrame:
    number = F.lpad((F.col("user_id") % 20).cast("string"), 3, "0")
    return _ad_facts(spark, sf_dir, campaign_id=F.concat(F.lit("C"), number))


def ad_keywords(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.get_json_object("props", "$.k").try_cast("bigint") % 10
    match_type = F.when(k % 3 == 0, "exact").when(k % 3 == 1, "phrase").when(k % 3 == 2, "broad")
    return _ad_facts(
        spark, sf_dir, keyword=F.concat(F.lit("kw_"), k), match_type=match_type
    )


def reviewer_funding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Units per part and month end, standing in for reviewed samples."""
    headers = table(spark, sf_dir, "orders").select("o_orderkey", "o_orderdate")
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_quantity")
    return (
        lines.join(headers, F.col("l_orderkey") == F.col("o_orderkey"))
        .groupBy(F.last_day("o_orderdate").alias("date"), F.col("l_partkey").alias("sku_id"))
        .agg(F.sum(F.col("l_quantity").cast("bigint")).alias("quantity"))
    )


def supply_price(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "part").select(
        F.col("p_partkey").alias("sku_id"),
        F.floor("p_retailprice").alias("supply_price"),
    )
