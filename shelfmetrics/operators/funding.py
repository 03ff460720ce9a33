"""Cost of reviewer programmes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FEE_PER_REVIEW = 125_000  # fixed value


def reviewer_funding_costs(funding: DataFrame, supply_price: DataFrame) -> DataFrame:
    """Participation fee, sample cost and their total per month end and SKU.

    ``supply_price`` holds one row per ``sku_id``. A SKU without a price keeps its
    row with an unknown sample cost and total.
    """
    return (
        funding.select("date", "sku_id", "quantity")
        .join(supply_price.select("sku_id", "supply_price"), "sku_id", "left")
        .withColumn("funding_cost", F.col("quantity") * F.lit(FEE_PER_REVIEW).cast("bigint"))
        .withColumn("sample_supply_cost", F.col("supply_price") * F.col("quantity"))
        .withColumn("total_cost", F.col("funding_cost") + F.col("sample_supply_cost"))
        .select("date", "sku_id", "quantity", "funding_cost", "sample_supply_cost", "total_cost")
    )
