"""A skew-proof equi-join of many rows with one-row-per-key statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SALTS = 8


def join_stats(
    rows: DataFrame,
    stats: DataFrame,
    keys: list[str],
    spread_by: list[str],
    how: str = "inner",
    salts: int = SALTS,
) -> DataFrame:
    """Join ``rows`` with ``stats``, which holds one row per ``keys``.

    A key that owns a large share of ``rows`` would send them all to one task, so
    rows are spread over ``salts`` sub-keys by their ``spread_by`` columns and the
    aggregated side is repeated once per sub-key. The extra key also makes both
    join inputs plain exchanges, which is the shape adaptive execution can split
    further. A small ``stats`` side is still broadcast, by its measured size.
    """
    salted = rows.withColumn("_salt", F.pmod(F.hash(*spread_by), F.lit(salts)))
    repeated = stats.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(salts - 1))))
    return salted.join(repeated, [*keys, "_salt"], how).drop("_salt")
