"""Metric formulas shared by every report, as plain column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def _col(value: Column | str) -> Column:
    return F.col(value) if isinstance(value, str) else value


def round_half_away(value: Column | str, places: int = 0) -> Column:
    """Round a double half away from zero.

    Written out instead of ``F.round`` so that any engine evaluating the same
    formula on the same double lands on the same value. It stays in doubles: from 2^53 on
    they have no fraction, so they pass through, as do infinity and NaN.
    """
    value = _col(value).cast("double")
    scale = F.lit(float(10**places))
    scaled = F.abs(value) * scale + F.lit(0.5)
    rounded = F.signum(value) * (scaled - scaled % 1.0) / scale
    return F.when(scaled >= float(2**53), value).otherwise(rounded)


def safe_div(numerator: Column | str, denominator: Column | str) -> Column:
    """Double division that is NULL for a zero or NULL denominator."""
    return F.try_divide(_col(numerator).cast("double"), _col(denominator).cast("double"))


def pct(part: Column | str, whole: Column | str, places: int = 1) -> Column:
    return round_half_away(safe_div(part, whole) * 100, places)


def change_pct(current: Column | str, previous: Column | str, places: int = 1) -> Column:
    current, previous = _col(current), _col(previous)
    return pct(current - previous, previous, places)


def money_sum(value: Column | str) -> Column:
    """Sum exactly in the column's own (decimal) type, then hand out a double."""
    return F.sum(value).cast("double")


def steady_avg(value: Column | str) -> Column:
    """Mean over an exact decimal sum, so it does not depend on the order of the rows.

    A mean of doubles wobbles in its last digits from run to run, enough to flip a
    rounding tie or a grade. Groups with values that 18 decimals and as many digits before
    the point cannot hold (NaN, infinity, 1e-30) get the mean of the doubles.
    """
    value = _col(value)
    exact = value.try_cast("decimal(38,18)")
    held = (exact.cast("double") == value.cast("double")) & (F.abs(exact) < 10**18)
    kept = F.when(held, exact)
    mean = safe_div(F.try_sum(kept), F.count(value))
    return F.when(F.count(kept) == F.count(value), mean).otherwise(F.avg(value.cast("double")))


def exact_stddev(value: Column | str) -> Column:
    """Sample deviation of whole numbers from their exact sums, in any order; NULL under two.

    The sums of squares stay below 10^38 for values below 10^14.
    """
    value = _col(value).cast("decimal(19,0)")
    n = F.count(value).cast("decimal(19,0)")
    total, squares = F.sum(value), F.sum((value * value).cast("decimal(38,0)"))
    spread = safe_div(squares.cast("decimal(38,0)") * n - total * total, n * (n - 1))
    return F.when(F.count(value) > 1, F.sqrt(spread))
