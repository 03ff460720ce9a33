"""Document fingerprints by one-permutation MinHash.

Each shingle of five words is hashed once. The low bits of the hash name a bin, a bin
keeps its least hash. An empty bin takes the value of a filled one: every pair of bins has
a fixed random priority, and the filled bin of least priority lends, which is the donor
that optimal densification's repeated random probing would reach. Of each bin eight bits
are stored, two hex digits; agreement by chance is taken off the likeness.

Only built-in functions are used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from shelfmetrics.llm.common import order_id, pipe, words

SHINGLE = 5
BINS = 128
BITS = 8


def bin_values(text: Column, bins: int = BINS) -> Column:
    """The low bits of each bin's least hash, after densification: array<smallint>.

    A text of fewer words than a shingle has one shingle of all its words; null counts as
    empty, which is a shingle of no words.
    """
    bin_bits = bins.bit_length() - 1
    assert bins == 1 << bin_bits, "bins must be a power of two"

    def shingles(hs: Column) -> Column:
        starts = F.sequence(F.lit(0), F.greatest(F.size(hs) - SHINGLE, F.lit(0)))
        parts = lambda i: [F.get(hs, i + k) for k in range(SHINGLE)]
        return F.sort_array(F.transform(starts, lambda i: F.xxhash64(*parts(i))))

    def leasts(hashes: Column) -> Column:
        # sorted, so a bin's least is where the top bits, the bin's number, change
        changed = F.filter(
            hashes,
            lambda h, i: F.shiftrightunsigned(h.bitwiseXOR(F.get(hashes, i - 1)), 64 - bin_bits)
            != 0,
        )
        return F.concat(F.slice(hashes, 1, 1), changed)

    # the sign bit puts the upper half of the bins first; the order of bins is of no matter
    entry = lambda h: F.struct(
        F.shiftrightunsigned(h, 64 - bin_bits).cast("int").alias("b"),
        h.bitwiseAND(F.lit((1 << BITS) - 1)).cast("smallint").alias("v"),
    )

    def densified(filled: Column) -> Column:
        lend = lambda b: F.array_min(
            F.transform(filled, lambda d: F.struct(F.xxhash64(b, d["b"]), d["v"].alias("v")))
        )["v"]
        return pipe(
            F.map_from_entries(filled),
            lambda own: F.transform(
                F.sequence(F.lit(0), F.lit(bins - 1)),
                lambda b: F.coalesce(F.try_element_at(own, b), lend(b)),
            ),
        )

    def of_hashes(hashes: Column) -> Column:
        return pipe(F.transform(leasts(hashes), entry), one)

    def one(filled: Column) -> Column:
        return F.when(
            F.size(filled) == bins, F.transform(F.array_sort(filled), lambda d: d["v"])
        ).otherwise(densified(filled))

    hashed = F.transform(words(text), lambda w: F.xxhash64(w))
    return pipe(pipe(hashed, shingles), of_hashes)


def packed(values: Column) -> Column:
    """Two hex digits a bin."""
    digits = F.array(*[F.lit(f"{v:02x}") for v in range(1 << BITS)])
    return F.array_join(F.transform(values, lambda v: F.get(digits, v.cast("int"))), "")


def likeness(a: Column, b: Column) -> Column:
    """Estimated Jaccard similarity of two texts by their bin values, 0 to 1."""
    same = F.size(F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda equal: equal))
    chance = 2.0**-BITS
    return F.greatest((same / F.size(a) - chance) / (1 - chance), F.lit(0.0))


def with_next(docs: DataFrame, values: list[str]) -> DataFrame:
    """Add next_<value>, of the next row by (id, t), after the last of the first row.

    The ids' quantiles cut the order into ranges, so the rows are exchanged once and no task
    gets them all; what follows a range is the first row of the next one, looked up by its id.
    """
    spark = docs.sparkSession
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    grid = [k / n for k in range(1, n)]
    cuts = docs.agg(F.percentile_approx("id", grid, 10_000)).first()[0] if grid else []
    cuts = sorted(set(cuts or []))
    cut = F.array(*[F.lit(c) for c in cuts]).cast("array<bigint>")
    docs = docs.withColumn("range", F.size(F.filter(cut, lambda c: c <= F.col("id"))))
    # the first id of each range that has rows: as many rows as ranges
    heads = [r[1] for r in sorted(docs.groupBy("range").agg(F.min("id")).collect())]
    ranges = Window.partitionBy("range").orderBy("id", "t")
    inner = docs.select(
        "*",
        F.lead(F.struct(*values)).over(ranges).alias("next"),
        F.row_number().over(ranges).alias("nth"),
    )
    if not heads:
        return inner.select(*docs.columns, *[F.col(f"next.{v}").alias(f"next_{v}") for v in values])
    # ids of range heads, each with the id of the head before which it stands
    firsts = (
        docs.where(F.col("id").isin(heads))
        .groupBy("id")
        .agg(F.min(F.struct("t", *[v for v in values if v != "t"])).alias("head"))
    )
    follows = spark.createDataFrame(
        [(h, heads[(i + 1) % len(heads)]) for i, h in enumerate(heads)], "head_id long, follow long"
    )
    first_of = docs.groupBy("range").agg(F.min("id").alias("head_id"))
    tails = first_of.join(follows, "head_id").join(firsts, F.col("follow") == firsts["id"])
    tails = tails.select("range", F.col("head"))
    last = F.col("next").isNull()
    joined = inner.join(F.broadcast(tails), "range", "left")
    return joined.select(
        *docs.columns,
        *[
            F.when(last, F.col(f"head.{v}")).otherwise(F.col(f"next.{v}")).alias(f"next_{v}")
            for v in values
        ],
    )


def edited_pairs(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Fingerprints of each text and of its edited text: its last half gives way to as many
    characters from the head of the next document.

    Null texts count as empty. Rows without an id come last; rows that share an id follow each
    other by text. One row alone is its own next document. An empty table gives no rows.
    Columns besides id and text are left out.
    """
    base = docs.select(
        F.col(id_col).alias("doc_id"),
        order_id(F.col(id_col)).alias("id"),
        F.coalesce(F.col(text_col), F.lit("")).alias("t"),
    )
    paired = with_next(base.withColumn("bins", bin_values(F.col("t"))), ["t", "bins"])
    n = F.char_length("t")
    half = F.floor(n / 2).cast("int")
    edited = F.concat(
        F.substring(F.col("t"), F.lit(1), n - half), F.substring(F.col("next_t"), F.lit(1), half)
    )
    out = paired.select(
        "doc_id",
        n.cast("long").alias("n_chars"),
        "bins",
        "next_bins",
        edited.alias("edited_text"),
    ).withColumn("edited_bins", bin_values(F.col("edited_text")))
    return out.select(
        "doc_id",
        "n_chars",
        "edited_text",
        packed(F.col("bins")).alias("fingerprint"),
        packed(F.col("edited_bins")).alias("edited_fingerprint"),
        likeness(F.col("bins"), F.col("edited_bins")).alias("near_edited"),
        likeness(F.col("bins"), F.col("next_bins")).alias("near_next"),
    )


def digest(docs: DataFrame) -> DataFrame:
    return edited_pairs(docs).select(
        "doc_id",
        "n_chars",
        F.sha2(F.encode("edited_text", "UTF-8"), 256).alias("edited_sha256"),
        "fingerprint",
        "edited_fingerprint",
        "near_edited",
        "near_next",
    )
