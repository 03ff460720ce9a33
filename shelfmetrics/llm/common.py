"""What several operators share: written tables, row keys, texts as words."""

from __future__ import annotations

import sys
import types

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmetrics.scratch import discard, new_path, settled, shared_dir, written

__all__ = ["discard", "new_path", "settled", "shared_dir", "written"]

#: Characters that separate words and are stripped from lines: [\x20\x09-\x0D].
BLANKS = " \t\n\x0b\x0c\r"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Where rows without a doc_id stand in the order of documents: after all others.
NO_ID = (1 << 63) - 1


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def order_id(doc_id: Column) -> Column:
    """doc_id as a place in the order of documents, never null."""
    return F.coalesce(doc_id.cast("long"), F.lit(NO_ID))


def ascii_lower(text: Column) -> Column:
    return F.translate(text, UPPER, LOWER)


def words(text: Column) -> Column:
    """The runs of [^\\x20\\x09-\\x0D] of a text; null or blank: an empty array."""
    spaced = F.coalesce(text, F.lit(""))
    for blank in BLANKS[1:]:
        spaced = F.replace(spaced, F.lit(blank), F.lit(" "))
    return F.array_remove(F.split(spaced, " ", -1), "")


def pipe(value: Column, then) -> Column:
    """then(value), with value computed once."""
    return F.get(F.transform(F.array(value), then), F.lit(0))


class Carried:
    """Rows on their way through Python, as `row` (the columns in carry; all by default) and `text`.
    A text that is carried, too, goes there and back once, beside `row` and not in it as well."""

    def __init__(self, docs: DataFrame, text_col: str, carry: list[str] | None):
        self.carry = docs.columns if carry is None else carry
        self.text_col = text_col
        once = text_col in self.carry and docs.schema[text_col].dataType.typeName() == "string"
        self.others = [c for c in self.carry if not (once and c == text_col)]
        #: What has to come back.
        self.names = ["row", "text"] if once else ["row"]

    def struct(self) -> Column:
        """What goes as `row`."""
        return F.struct(*([F.col(f"`{c}`") for c in self.others] or [F.lit(0).alias("none")]))

    def sent(self, docs: DataFrame) -> DataFrame:
        return docs.select(self.struct().alias("row"), F.col(f"`{self.text_col}`").cast("string").alias("text"))

    def whole(self, row: str = "row", text: str = "text") -> Column:
        """The row with all its columns again."""
        if self.names == ["row"] and self.others:
            return F.col(row)
        fields = [F.col(f"{row}.`{c}`") if c in self.others else F.col(text) for c in self.carry]
        return F.struct(*[f.alias(c) for f, c in zip(fields, self.carry, strict=True)])


def worker_cache(operator: str) -> dict:
    """What an operator keeps in this worker process from task to task. Workers are used again by
    other stages: what another operator has kept goes then."""
    kept = sys.modules.setdefault("worker_caches", types.ModuleType("worker_caches")).__dict__.setdefault("of", {})
    for other in [o for o in kept if o != operator]:
        del kept[other]
    return kept.setdefault(operator, {})
