"""Target-distribution importance resampling.

Words and word pairs are dealt into buckets by their CRC-32. How much more common a bucket is in
the target than in the documents is its gain; a document's weight is the mean gain of its
features. Weights plus Gumbel noise from the ids are the scores, and the highest ones are drawn:
that is sampling without replacement in proportion to the weights.

1. Features are counted per bucket inside tasks, so one row a bucket and task is shuffled. The
   gains are an array of a fixed length, by which every text is scored in a second pass.
2. The cutoff: a quantile sketch names a bracket of scores around it. Exact counts of the rows
   above and inside either confirm the bracket or widen it. Only rows in the bracket are sorted,
   range by range, and the one at the wanted place is the cutoff.
3. The rows drawn get their ranks from their range and its offset. No task sees all of them.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.functions.positions import with_position
from shelfmetrics.llm import symbols
from shelfmetrics.llm.common import written
from shelfmetrics.llm.symbols import LOWER, NOT_ALNUM

BUCKETS = 10_000
PERCENT = 25
LEAST_WORDS = 20
SEED = 7
#: Half the bracket's first width, as a part of all rows, and the sketch's accuracy.
BRACKET, ACCURACY = 0.005, 2_000
#: Words hashed at a time, and the length beyond which one is hashed by itself.
STEP, LONG = 1 << 18, 48


def _crc_table() -> np.ndarray:
    c = np.arange(256, dtype=np.uint32)
    for _ in range(8):
        c = np.where(c & 1, (c >> np.uint32(1)) ^ np.uint32(0xEDB88320), c >> np.uint32(1))
    return c


CRC = _crc_table()
ALL = np.uint32(0xFFFFFFFF)


def _fed(state: np.ndarray, byte: np.ndarray) -> np.ndarray:
    return CRC[(state ^ byte) & np.uint32(0xFF)] ^ (state >> np.uint32(8))


def _run_on(state: np.ndarray, raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """CRC states after the bytes of each span, from the states before them."""
    state, length = state.copy(), end - start
    for k in np.flatnonzero(length > LONG):
        state[k] = zlib.crc32(raw[start[k] : end[k]], int(state[k] ^ ALL)) ^ 0xFFFFFFFF
    alive = np.flatnonzero(length <= LONG)
    for j in range(LONG):
        alive = alive[length[alive] > j]
        if not len(alive):
            break
        state[alive] = _fed(state[alive], raw[start[alive] + j])
    return state


def feature_buckets(raw: np.ndarray, start: np.ndarray, end: np.ndarray, buckets: int) -> tuple:
    """The bucket of each word, and of each word with the next one (one fewer)."""
    words, pairs = np.empty(len(start), np.int64), np.empty(max(len(start) - 1, 0), np.int64)
    for at in range(0, len(start), STEP):
        a, b = start[at : at + STEP + 1], end[at : at + STEP + 1]
        state = _run_on(np.full(min(STEP, len(a)), ALL), raw, a[:STEP], b[:STEP])
        words[at : at + len(state)] = (state ^ ALL) % np.uint32(buckets)
        state = state[: len(a) - 1]
        both = _run_on(_fed(state, np.uint32(0x20)), raw, a[1:], b[1:])
        pairs[at : at + len(both)] = (both ^ ALL) % np.uint32(buckets)
    return words, pairs


def _features(batch: pa.RecordBatch, buckets: int) -> Iterator[tuple]:
    """(rows, words' and pairs' buckets, where each text's words begin). A pair that begins with
    the last word of a text is none."""
    for part, raw, offsets in symbols.slices(batch, "text"):
        raw = LOWER[raw]
        start, end, first = symbols.words(raw, offsets, NOT_ALNUM)
        yield part, *feature_buckets(raw, start, end, buckets), first


def _counts(buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(buckets, np.int64)
        for batch in batches:
            for _, words, pairs, first in _features(batch, buckets):
                total += np.bincount(words, minlength=buckets)
                inside = np.ones(len(pairs), bool)
                last = first[1:-1] - 1
                inside[last[(last >= 0) & (last < len(pairs))]] = False
                total += np.bincount(pairs[inside], minlength=buckets)
        had = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(had), pa.array(total[had])], ["bucket", "n"])

    return run


def bucket_counts(docs: DataFrame, text_col: str = "text", buckets: int = BUCKETS) -> np.ndarray:
    """Features per bucket over all rows: an array of a fixed length."""
    texts = docs.select(F.col(f"`{text_col}`").alias("text"))
    rows = texts.mapInArrow(_counts(buckets), "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))
    out = np.zeros(buckets, np.int64)
    for bucket, n in rows.collect():  # a row for each bucket at most
        out[bucket] = n
    return out


def gains(own: np.ndarray, target: np.ndarray) -> np.ndarray:
    """floor(1000 * ln of the ratio of smoothed shares) of each bucket."""
    k, s_all, t_all = len(own), int(own.sum()), int(target.sum())
    ratio = [
        float(t + 1) * float(s_all + k) / (float(s + 1) * float(t_all + k))
        for s, t in zip(own.tolist(), target.tolist(), strict=True)
    ]
    return np.array([math.floor(1000 * math.log(x)) for x in ratio], np.int64)


def _weights(gain: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, words, pairs, first in _features(batch, len(gain)):
                n = np.diff(first)
                sums = np.concatenate([[0], np.cumsum(gain[words])])
                pair_sums = np.concatenate([[0], np.cumsum(gain[pairs])])
                of_pairs = np.where(n > 1, pair_sums[np.maximum(first[1:] - 1, 0)] - pair_sums[np.minimum(first[:-1], len(pairs))], 0)
                total = sums[first[1:]] - sums[first[:-1]] + of_pairs
                features = np.maximum(2 * n - 1, 0)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("id"),
                        pa.array(n, pa.int64()),
                        pa.array(features, pa.int64()),
                        pa.array(np.where(features > 0, total // np.maximum(features, 1), 0), pa.int64()),
                    ],
                    ["row", "id", "n_words", "n_features", "weight"],
                )

    return run


def noise(doc_id: Column, seed: int) -> Column:
    """1000 times Gumbel noise that the seed and the id fix, floored."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), doc_id.cast("string")), 256)
    h = F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / F.lit(4294967296.0))))


def bracket(scores: DataFrame, rank: int, n: int, width: float = BRACKET) -> tuple:
    """(low, high, above): the rank-th highest score lies from low to high, and `above` rows have
    a higher one than high. scores: n rows with a column score."""
    while True:
        share = 1 - rank / n
        parts = [max(0.0, share - width), min(1.0, share + width)]
        low, high = scores.agg(F.percentile_approx("score", parts, ACCURACY)).first()[0]
        if width >= 1:
            low, high = scores.agg(F.min("score"), F.max("score")).first()
        above, inside = scores.agg(
            F.count_if(F.col("score") > high), F.count_if(F.col("score").between(low, high))
        ).first()
        if above < rank <= above + inside:
            return low, high, above
        width *= 8


def _order() -> list[Column]:
    return [F.col("score").desc(), F.col("id"), F.col("n_features"), F.col("weight")]


def _not_after(cut) -> Column:
    """Whether a row stands before the cut in the order, or beside it."""
    out = F.col("weight") <= cut["weight"]
    for name in ("n_features", "id"):
        out = (F.col(name) < cut[name]) | ((F.col(name) == cut[name]) & out)
    return (F.col("score") > cut["score"]) | ((F.col("score") == cut["score"]) & out)


def cutoff(scores: DataFrame, rank: int, n: int):
    """The rank-th of n rows in the order of the draw."""
    low, high, above = bracket(scores, rank, n)
    inside = scores.where(F.col("score").between(low, high)).select("score", "id", "n_features", "weight")
    return with_position(inside, _order(), position="place").where(F.col("place") == rank - above).first()


def resample(
    docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    target_text_col: str = "text", percent: int = PERCENT, least_words: int = LEAST_WORDS,
    buckets: int = BUCKETS, seed: int = SEED, carry: list[str] | None = None,
) -> DataFrame:
    """Draw `percent` in a hundred of the documents of `least_words` words or more, the likelier
    the more their words resemble the target's.

    Returns per row of docs: `row` (the columns in carry; all by default), n_words, n_features,
    weight, score and rank (from 1, by falling score, then rising id; null where not drawn).
    Words are runs of ASCII letters (A-Z lower-cased), digits and characters beyond ASCII. Null,
    empty and wordless texts have no feature and weight 0. Rows without an id have no score, are
    not drawn and not counted among those to draw from. Rows of equal id and score go by
    n_features and weight, equal ones in any order; each counts. Without a target text all
    buckets have as good as the same gain. Empty tables give no rows.
    """
    gain = gains(bucket_counts(docs, text_col, buckets), bucket_counts(target, target_text_col, buckets))
    given = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"),
        F.col(f"`{id_col}`").cast("long").alias("id"),
        F.col(f"`{text_col}`").alias("text"),
    )
    long = F.lit(0).cast("long")
    schema = given.select(
        "row", "id", long.alias("n_words"), long.alias("n_features"), long.alias("weight")
    ).schema
    scored = given.mapInArrow(_weights(gain), schema)
    scored = written(scored.withColumn("score", F.col("weight") + noise(F.col("id"), seed)), "scored")
    may = F.col("id").isNotNull() & (F.col("n_words") >= least_words)
    n = scored.where(may).count()
    rank = n * percent // 100
    columns = ["row", "n_words", "n_features", "weight", "score"]
    nothing = F.lit(None).cast("long").alias("rank")
    if not rank:
        return scored.select(*columns, nothing)
    drawn = may & _not_after(cutoff(scored.where(may), rank, n))
    ranked = with_position(scored.where(drawn), _order(), position="place")
    # the cut may stand among equal rows
    placed = F.when(F.col("place") <= rank, F.col("place")).alias("rank")
    return ranked.select(*columns, placed).unionAll(scored.where(~drawn | drawn.isNull()).select(*columns, nothing))


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    done = resample(docs.select("doc_id", "text"), benchmark.select("text"), carry=["doc_id"])
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_features", "weight", "score", "rank")


ORACLE_SQL = r"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT unnest(range(256)), 0, unnest(range(256))
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
w AS (
  SELECT kind, doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM (SELECT 0 AS kind, doc_id, text FROM documents UNION ALL SELECT 1, NULL, text FROM benchmark)
), f AS (
  SELECT kind, doc_id, unnest(ws || list_transform(range(1, len(ws)), lambda i: ws[i] || ' ' || ws[i + 1])) AS g FROM w
), k AS (SELECT kind, doc_id, g, count(*) AS n FROM f GROUP BY ALL),
b AS (
  SELECT g, xor(list_reduce(
    list_transform(range(0, strlen(g)), lambda i: 16 * (instr('0123456789ABCDEF', substr(hex(encode(g)), 2 * i + 1, 1)) - 1)
      + instr('0123456789ABCDEF', substr(hex(encode(g)), 2 * i + 2, 1)) - 1),
    lambda c, x: xor(t[(xor(c, x) & 255) + 1], c >> 8), 4294967295), 4294967295) % 10000 AS bucket
  FROM (SELECT DISTINCT g FROM k), crc
), c AS (
  SELECT bucket, coalesce(sum(n) FILTER (WHERE kind = 0), 0) AS s, coalesce(sum(n) FILTER (WHERE kind = 1), 0) AS t
  FROM k JOIN b USING (g) GROUP BY bucket
), gain AS (
  SELECT bucket, floor(1000 * ln(((t + 1)::DOUBLE * ((SELECT sum(s) FROM c) + 10000)::DOUBLE)
    / ((s + 1)::DOUBLE * ((SELECT sum(t) FROM c) + 10000)::DOUBLE)))::BIGINT AS gain FROM c
), d AS (
  SELECT doc_id, sum(n)::BIGINT AS n_features, floor(sum(n * gain)::DOUBLE / sum(n))::BIGINT AS weight
  FROM k JOIN b USING (g) JOIN gain USING (bucket) WHERE kind = 0 GROUP BY doc_id
), a AS (
  SELECT w.doc_id, len(ws) AS n_words, coalesce(n_features, 0) AS n_features, coalesce(weight, 0) AS weight,
    list_reduce(list_transform(range(1, 9), lambda i: instr('0123456789abcdef', substr(sha256('7:' || w.doc_id), i, 1))::BIGINT - 1),
      lambda x, y: x * 16 + y) AS h
  FROM w LEFT JOIN d ON d.doc_id = w.doc_id WHERE kind = 0
), s AS (
  SELECT *, weight + floor(-1000 * ln(-ln((h + 0.5::DOUBLE) / 4294967296::DOUBLE)))::BIGINT AS score FROM a
), r AS (
  SELECT doc_id, row_number() OVER (ORDER BY score DESC, doc_id) AS rank, count(*) OVER () AS n
  FROM s WHERE n_words >= 20
)
SELECT s.doc_id, s.n_features, s.weight, s.score, r.rank
FROM s LEFT JOIN r ON r.doc_id = s.doc_id AND r.rank <= 25 * r.n // 100
"""
