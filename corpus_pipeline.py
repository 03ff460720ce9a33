"""From raw documents to token ids: five stages, each on all that its predecessor kept.

Each stage takes (spark, docs, sf_dir) and returns rows that are written as Parquet and read
again as the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfmetrics.llm import bpe, decontaminate, language, line_dedup, ngram_join
from shelfmetrics.llm.common import table, written
from shelfmetrics.scratch import SETTINGS

NEAR_SHINGLE, NEAR_PERCENT = 5, 80
#: Rows of one batch on the way to Python, and how many Spark takes if nothing is set.
BATCH, DEFAULT_BATCH = "spark.sql.execution.arrow.maxRecordsPerBatch", "10000"
#: From this score on the language that was identified takes the place of another label.
CERTAIN = 0.99


def _columns(docs: DataFrame, **other: Column) -> list[Column]:
    """The columns of docs out of `row`, some of them computed anew."""
    return [other.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns]


def _small_batches(spark: SparkSession) -> None:
    """Stages return rows that Python makes while the caller writes them. Rows go there in batches as
    small as in written(), unless the session says how large: texts are long, and a batch is held
    by Spark and by the worker."""
    if spark.conf.get(BATCH) == DEFAULT_BATCH:
        spark.conf.set(BATCH, SETTINGS[BATCH])


def identify_language(
    spark: SparkSession, docs: DataFrame, sf_dir: str, languages: list[str] | None = None
) -> DataFrame:
    """Documents in the languages named, or in any that could be learned; those without a letter
    (null and empty texts, too) go. lang becomes what the text is identified as, where it was null
    or the identification is certain. All rows stay as they are where no language could be learned."""
    _small_batches(spark)
    model = language.train(docs)
    if not model.languages:
        return docs
    found = language.predict(docs, model)
    wanted = F.col("lang_pred") != language.UNDETERMINED
    if languages is not None:
        wanted &= F.col("lang_pred").isin(languages)
    lang = F.when(F.col("score") >= CERTAIN, F.col("lang_pred")).otherwise(F.coalesce("row.lang", "lang_pred"))
    return found.where(wanted).select(*_columns(docs, lang=lang))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Take lines that an earlier document has out of the texts. Null texts stay null."""
    done = line_dedup.drop_repeated_lines(docs)
    text = F.when(F.col("row.text").isNotNull(), F.col("kept_text"))
    return done.select(*_columns(docs, text=text, n_chars=F.coalesce(F.char_length(text).cast("long"), F.lit(0).cast("long"))))


def keep_one_of_similar(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of linked documents the one of least id stays; rows of equal id and text
    are one. Documents of no words, or without an id, are in no group and stay."""
    _small_batches(spark)
    done = ngram_join.join_similar(docs, size=NEAR_SHINGLE, percent=NEAR_PERCENT)
    stays = F.col("component_id").isNull() | (F.col("component_id") == F.col("row.doc_id"))
    kept = done.where(stays).select("row", "n_shingles", F.col("row.doc_id").alias("id"))
    ids = docs.where("doc_id is not null").groupBy(F.col("doc_id").alias("id")).count()
    repeated = written(ids.where("count > 1").select("id", F.lit(True).alias("again")), "repeated-ids")
    if repeated.isEmpty():
        return kept.select(*_columns(docs))
    rows = kept.join(repeated, "id", "left").withColumn("again", F.coalesce("again", F.lit(False)) & (F.col("n_shingles") > 0))
    once = rows.where("again").withColumn("text", F.col("row.text")).dropDuplicates(["id", "text"])
    return rows.where("not again").select(*_columns(docs)).unionByName(once.select(*_columns(docs)))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Reject documents in which a test string of the benchmark occurs. Null and wordless texts
    have none and stay; so does everything where the benchmark is empty."""
    _small_batches(spark)
    found = decontaminate.find_leaks(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size("spans") == 0).select(*_columns(docs))


def tokenise(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids (little-endian unsigned 32-bit integers), and whether they decode to the text. A
    null text is encoded as an empty one, which has no tokens."""
    _small_batches(spark)
    coded = bpe.encode_decode(docs)
    text = F.encode(F.coalesce(F.col("row.text"), F.lit("")), "UTF-8")
    named = [F.col(f"row.{c}") if c in docs.columns else F.lit(None).cast("string").alias(c) for c in ("lang", "source")]
    return coded.select(
        "row.doc_id",
        *named,
        (F.length("ids") / 4).cast("long").alias("n_tokens"),
        "ids",
        F.sha2("ids", 256).alias("ids_sha256"),
        (F.col("decoded") == text).alias("round_trip"),
    )


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("language ID", identify_language),
    ("line dedup", drop_repeated_lines),
    ("n-gram Jaccard join", keep_one_of_similar),
    ("benchmark decontamination", drop_contaminated),
    ("byte-level BPE", tokenise),
]

#: Language scores and tokens are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name.replace(" ", "-"))
    return docs
