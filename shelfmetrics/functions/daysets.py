"""Sets of days as bits, exact and mergeable.

A set is a row for each 64 days in which it has one, with those days as the bits of a BIGINT. Sets
of different days, warehouses or channels merge by OR, so they can be stored and added to day by
day. Counting days in any range is counting bits.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.functions.days import Day, as_date

BITS = 64
_EPOCH = as_date("1970-01-01")


def day_sets(df: DataFrame, keys: list[str], day: str) -> DataFrame:
    """The days that rows of each key have: (keys, block, days). NULL days are in no set."""
    number = F.unix_date(F.to_date(F.col(day)))
    bit = F.expr(f"shiftleft(1L, cast(pmod(unix_date(to_date(`{day}`)), {BITS}) as int))")
    return (
        df.where(F.col(day).isNotNull())
        .groupBy(*keys, F.floor(number / BITS).alias("block"))
        .agg(F.bit_or(bit).alias("days"))
    )


def merged(sets: DataFrame, keys: list[str]) -> DataFrame:
    """The union of the sets of all rows with the same keys."""
    return sets.groupBy(*keys, "block").agg(F.bit_or("days").alias("days"))


def days_within(first: Day, last: Day) -> Column:
    """How many days of a row's set lie in a closed range; sum it over a key's rows."""
    low, high = (as_date(d).toordinal() - _EPOCH.toordinal() for d in (first, last))
    start = F.col("block") * BITS
    # the block's days from low on, and up to high
    skip = F.greatest(F.lit(low) - start, F.lit(0)).cast("int")
    over = F.greatest(start + (BITS - 1) - F.lit(high), F.lit(0)).cast("int")
    ones = F.lit(-1).cast("long")
    # shifts go modulo 64, so blocks outside of the range are told apart
    mask = F.call_function("shiftleft", ones, skip).bitwiseAND(
        F.call_function("shiftrightunsigned", ones, over)
    )
    inside = (skip < BITS) & (over < BITS)
    return F.when(inside, F.bit_count(F.col("days").bitwiseAND(mask))).otherwise(0)
