"""Row numbers over whole tables, without a task that sees all rows.

Rows are cut into ranges of the wanted order, sorted within each, and written with their place in
the range. Counts per range then give each range's offset. Tasks hold one range; what is summed up
in order has one row for each range (and group), however long the table is.
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.scratch import written

#: monotonically_increasing_id() holds the task above so many bits, the row in the task below.
_ROW_BITS = 33


def with_position(
    df: DataFrame,
    order: Sequence[Column],
    groups: Sequence[str] = (),
    position: str = "position",
    total: str | None = None,
    ranges: int | None = None,
) -> DataFrame:
    """df with a bigint column ``position``: 1, 2, 3, ... in the given order, in each group anew.

    ``order`` are sort expressions over df, ``groups`` columns (null is a value, and comes first),
    ``total`` names a further column for the rows of the group. Rows that are equal in ``order``
    are numbered in any order among themselves, and may lie in different ranges, so that a value
    which most rows share is split. ``ranges`` is the number of ranges; by default that of shuffle
    partitions. An empty table gives no rows.
    """
    own = uuid.uuid4().hex[:8]
    serial, row, part, first, count, offset, rows = (f"_{n}_{own}" for n in "serial row part first count offset rows".split())
    spark = df.sparkSession
    keys = [*[F.col(f"`{g}`").asc_nulls_first() for g in groups], *order, F.col(serial)]
    numbered = df.withColumn(serial, F.monotonically_increasing_id())
    cut = numbered.repartitionByRange(ranges, *keys) if ranges else numbered.repartitionByRange(*keys)
    cut = cut.sortWithinPartitions(*keys).drop(serial).withColumn(row, F.monotonically_increasing_id())
    table = written(cut.withColumn(part, F.shiftright(row, _ROW_BITS)), "ranges")

    names = [f"_g{k}_{own}" for k in range(len(groups))]
    given = [F.col(f"`{g}`").alias(n) for g, n in zip(groups, names, strict=True)]
    counts = table.groupBy(F.col(part).alias(f"{part}_"), *given).agg(
        F.min(row).alias(first), F.count(F.lit(1)).alias(count)
    )
    if groups:
        before = Window.partitionBy(*names).orderBy(f"{part}_").rowsBetween(Window.unboundedPreceding, -1)
        counts = counts.withColumns({
            offset: F.coalesce(F.sum(count).over(before), F.lit(0)),
            rows: F.sum(count).over(Window.partitionBy(*names)),
        })
    else:
        done, lines = 0, sorted(tuple(r) for r in counts.collect())  # one for each range
        everything = sum(n for _, _, n in lines)
        offsets = []
        for at, low, n in lines:
            offsets.append((at, low, n, done, everything))
            done += n
        schema = ", ".join(f"`{n}` long" for n in (f"{part}_", first, count, offset, rows))
        counts = spark.createDataFrame(offsets, schema)
    same = [F.col(part) == F.col(f"{part}_")]
    same += [F.col(f"`{g}`").eqNullSafe(F.col(n)) for g, n in zip(groups, names, strict=True)]
    out = table.join(counts, reduce(Column.__and__, same))
    more = {position: F.col(row) - F.col(first) + F.col(offset) + 1}
    if total:
        more[total] = F.col(rows)
    return out.select(*[F.col(f"`{c}`") for c in df.columns], *[v.alias(n) for n, v in more.items()])
