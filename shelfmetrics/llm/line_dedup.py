"""Line dedup over levelled, sorted runs of line hashes.

An index is a set of runs: tables (h1, h2, holder, shared), sorted by hash within hash
partitions, no key in two runs. Documents come in batches of ascending id. Each batch's
distinct keys are merge-joined with the runs: keys without a partner there (the
anti-join) become a run of their own on level 0, the others are hits on an older holder.
As soon as a level is full its runs are merged into one run of the next level, so a batch
meets a number of runs that grows with the logarithm of the batches.

A key is known by two 64-bit hashes with different seeds. Only built-in functions are used.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmetrics.llm.common import BLANKS, ascii_lower, discard, new_path, order_id, written

MIN_CHARS = 10
BATCHES = 4
FAN_IN = 2
KEY = ["h1", "h2"]


class LineRuns:
    """Levelled runs of line hashes in the shared folder."""

    def __init__(self, spark: SparkSession, fan_in: int = FAN_IN):
        self.spark, self.fan_in = spark, fan_in
        self.levels: list[list[DataFrame]] = [[]]
        self.hits: list[DataFrame] = []
        self.tables: list[DataFrame] = []

    def runs(self) -> list[DataFrame]:
        return [run for level in self.levels for run in level]

    def _compact(self) -> None:
        for k in range(len(self.levels)):
            if len(self.levels[k]) < self.fan_in:
                break
            merged = reduce(DataFrame.unionByName, self.levels[k])
            merged = merged.repartition(*KEY).sortWithinPartitions(*KEY)
            self.levels[k] = []
            if k + 1 == len(self.levels):
                self.levels.append([])
            self.levels[k + 1].append(written(merged, "line-run"))
            self.tables.append(self.levels[k + 1][-1])

    def add(self, lines: DataFrame) -> None:
        """Take a batch of lines (h1, h2, id); its ids must exceed those of earlier batches."""
        self._compact()
        keys = lines.groupBy(*KEY).agg(F.min("id").alias("low"), F.max("id").alias("high"))
        known = self.runs()
        if known:
            old = reduce(DataFrame.unionByName, known).select(*KEY, F.col("holder").alias("old"))
            met = keys.join(old, KEY, "left")
        else:
            met = keys.withColumn("old", F.lit(None).cast("long"))
        met = met.select(
            *KEY,
            F.coalesce("old", "low").alias("holder"),
            (F.col("low") < F.col("high")).alias("shared"),
            F.col("old").isNull().alias("fresh"),
        )
        path = new_path(self.spark, "line-batch")
        met.sortWithinPartitions("fresh", *KEY).write.partitionBy("fresh").parquet(path)
        batch = self.spark.read.schema(met.schema).parquet(path)
        batch._scratch = path
        self.tables.append(batch)
        self.levels[0].append(batch.where("fresh").drop("fresh"))
        self.hits.append(batch.where("not fresh").drop("fresh"))

    def repeated(self) -> DataFrame:
        """(h1, h2, holder) of every key that more than one document holds."""
        parts = [run.where("shared") for run in self.runs()] + self.hits
        return reduce(DataFrame.unionByName, parts).groupBy(*KEY).agg(F.min("holder").alias("holder"))


def _lines(text: Column) -> Column:
    return F.split(F.coalesce(text, F.lit("")), "\n", -1)


def drop_repeated_lines(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = MIN_CHARS,
    batches: int = BATCHES,
    fan_in: int = FAN_IN,
) -> DataFrame:
    """Drop every line whose key an earlier document holds.

    Returns the rows of docs as struct `row`, with n_lines, n_dropped and kept_text.
    A null or empty text is one empty line. Rows without an id come last and count as one
    document, as do rows that share an id; repeated rows all get the same result. An empty
    table gives an empty result. Columns besides id and text are carried in `row` untouched.
    """
    spark = docs.sparkSession
    base = docs.select(
        F.struct("*").alias("row"),
        order_id(F.col(id_col)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
    ).withColumn("th", F.xxhash64("t"))
    cuts = base.agg(
        F.percentile_approx("id", [k / batches for k in range(1, batches)], 1000)
    ).first()[0]
    cuts = sorted(set(cuts or []))
    batch = reduce(lambda a, c: a + (F.col("id") > c).cast("int"), cuts, F.lit(0))
    key = F.btrim(F.col("line"), F.lit(BLANKS))
    lines = (
        base.select(
            batch.alias("batch"), "id", "th", F.posexplode(_lines(ascii_lower(F.col("t"))))
        )
        .withColumnRenamed("col", "line")
        .select("batch", "id", "th", "pos", key.alias("key"))
        .where(F.char_length("key") >= min_chars)
        .select(
            "batch",
            "id",
            "th",
            "pos",
            F.xxhash64("key").alias("h1"),
            F.xxhash64(F.lit("line"), "key").alias("h2"),
        )
    )
    lines = written(lines, "line-keys")
    index = LineRuns(spark, fan_in)
    for k in range(len(cuts) + 1):
        index.add(lines.where(F.col("batch") == k))
    # read from a table, so that both sides of the join are plain exchanges and adaptive
    # execution can split the partition of a very frequent line
    repeated = written(index.repeated(), "line-repeated")
    discard(*index.tables)
    dropped = (
        lines.join(repeated, KEY)
        .where(F.col("id") > F.col("holder"))
        .groupBy("id", "th")
        .agg(F.collect_set("pos").alias("drop"))
    )
    joined = base.join(dropped, ["id", "th"], "left").withColumn("lines", _lines(F.col("t")))
    n = F.size("lines")
    kept = F.array_except(F.sequence(F.lit(0), n - 1), F.col("drop"))
    return joined.select(
        "row",
        n.cast("long").alias("n_lines"),
        F.coalesce(F.size("drop"), F.lit(0)).cast("long").alias("n_dropped"),
        F.when(F.col("drop").isNull(), F.col("t"))
        .otherwise(F.array_join(F.transform(kept, lambda p: F.get("lines", p)), "\n"))
        .alias("kept_text"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return drop_repeated_lines(docs).select(
        F.col("row.doc_id").alias("doc_id"),
        "n_lines",
        F.when(F.col("n_dropped") > 0, F.col("n_dropped")).otherwise(F.lit(0)).alias("n_dropped"),
        F.sha2(F.encode("kept_text", "UTF-8"), 256).alias("kept_sha256"),
    )


ORACLE_SQL = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos
  FROM documents
), k AS (
  SELECT doc_id, pos, line,
         translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                   'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), m AS (
  SELECT *, length(key) >= 10 AND min(doc_id) OVER (PARTITION BY key) < doc_id AS gone FROM k
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (WHERE gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone), ''))
         AS kept_sha256
FROM m GROUP BY doc_id
"""
