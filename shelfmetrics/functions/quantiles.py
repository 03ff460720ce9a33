"""Quantile summaries that merge, with a bound on how far a rank can be off.

A summary of a group's n values, in their order, is the last value of each run of ceil(n / SIZE)
consecutive ones, with the run's length: SIZE rows at most. Summaries of several groups merge by
putting their rows together. For any value, each summary knows the rank among its own values up to
one run, so in the union a rank is off by less than the sum of the run lengths: about 1 / SIZE of
all values, plus one for each summary. It depends on the values alone, not on how rows are dealt.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.functions.positions import with_position

SIZE = 100


def summaries(df: DataFrame, groups: list[str], value: str, size: int = SIZE) -> DataFrame:
    """(groups, value, held, run, last): of each group, values and how many values each stands for,
    the length of its runs, and whether it is the group's last run. Missing values are left out. A group of most rows is cut by ranges."""
    known = df.where(F.col(value).isNotNull()).select(*groups, F.col(value).alias("value"))
    placed = with_position(known, [F.col("value")], groups, "place", "n")
    run = F.ceil(F.col("n") / size).cast("long")
    return (
        placed.withColumn("run", run)
        .groupBy(*groups, "run", F.floor((F.col("place") - 1) / F.col("run")).alias("nth"))
        .agg(
            F.max("value").alias("value"), F.count(F.lit(1)).alias("held"),
            F.bool_or(F.col("place") == F.col("n")).alias("last"),
        )
        .select(*groups, "value", "held", "run", "last")
    )


def quantiles(stored: DataFrame, keys: list[str], percentiles: list[int]) -> DataFrame:
    """(keys, percentile, n, value, bound) from the summaries of all groups with the same keys.

    The value is that at which the summaries reach rank ceil(percentile * n / 100), at least 1. Among
    all values its rank is off by at most ``bound``. ``stored`` holds whole summaries. What is
    summed in order has a row for each distinct value of a key's summaries.
    """
    by_value = stored.groupBy(*keys, "value").agg(F.sum("held").alias("held"))
    sizes = stored.groupBy(*keys).agg(
        F.sum("held").alias("n"), F.sum(F.when(F.col("last"), F.col("run"))).alias("bound")
    )
    upto = Window.partitionBy(*keys).orderBy("value").rowsBetween(Window.unboundedPreceding, 0)
    asked = F.explode(F.array(*[F.lit(p) for p in percentiles])).alias("percentile")
    rank = F.greatest(F.lit(1), F.ceil(F.col("percentile") * F.col("n") / 100))
    return (
        by_value.withColumn("high", F.sum("held").over(upto))
        .join(sizes, keys)
        .select("*", asked)
        .where((rank <= F.col("high")) & (rank > F.col("high") - F.col("held")))
        .select(*keys, "percentile", "n", "value", "bound")
    )
