"""Approximate nearest neighbours by an adaptive dimension scan.

Vectors are dealt into lists by their nearest centroid. Each list lies in blocks of a bounded
size, and a block holds its vectors rotated at random and cut into blocks of columns.

1. Equal vectors are one, with the K + 1 least of their ids: no result needs more of them.
2. Centroids are fitted on a bounded sample. All vectors are indexed.
3. A first look into one block of a near list gives each query a threshold: the score of the
   best K + 1 found there. How far a list's vectors lie around its centroid says how many of them
   are to be expected above it. Lists are probed until less than MISSED of the K results is to be
   expected in all others together, so that clear clusters need few lists and noise needs many.
4. Within a probed list, partial distances grow column block by column block. Since the rotation
   is random, d of D columns hold d / D of a squared distance up to a known error; a candidate
   whose partial distance refutes that it reaches the threshold is given up. Those that stay to
   the end are scored on the original vectors.

Queries meet blocks in a cogroup by (list, block); what a block hands on is its K + 1 best above
the threshold for each query.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.llm.common import discard, written

K = 20
QUERY_EVERY = 20
#: The fit: lists by the root of the number of vectors, and vectors of the sample for each list.
MOST_LISTS, SAMPLE_PER_LIST, ROUNDS = 2048, 48, 8
#: Vectors in one block, and columns in one column block.
BLOCK, COLUMNS = 1024, 16
#: The part of the K results that may be expected in lists that are not probed.
MISSED = 0.05
#: Of the hypothesis test: how many standard deviations too large a partial distance may be.
ERROR = 2.5
SEED = 11
#: Queries compared with a block at a time, and queries that one task gets with a block, about.
CHUNK, QUERIES = 256, 20_000


def usable(vector: Column) -> Column:
    """Whether a vector takes part: neither null nor zero, all components finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def rotation(size: int, seed: int = SEED) -> np.ndarray:
    """A random orthogonal matrix."""
    q, r = np.linalg.qr(np.random.default_rng(seed).standard_normal((size, size)))
    return q * np.sign(np.diag(r))


def fit(sample: np.ndarray, lists: int, seed: int = SEED) -> np.ndarray:
    """Centroids by k-means."""
    rng = np.random.default_rng(seed)
    centres = sample[rng.choice(len(sample), min(lists, len(sample)), replace=False)]
    for _ in range(ROUNDS):
        own = nearest(sample, centres)
        count = np.bincount(own, minlength=len(centres))
        sums = np.zeros_like(centres)
        np.add.at(sums, own, sample)
        centres = np.where(count[:, None] > 0, sums / np.maximum(count, 1)[:, None], centres)
    return centres


def nearest(vectors: np.ndarray, centres: np.ndarray) -> np.ndarray:
    out = np.empty(len(vectors), np.int64)
    half = (centres**2).sum(axis=1) / 2
    for at in range(0, len(vectors), 4096):
        out[at : at + 4096] = (vectors[at : at + 4096] @ centres.T - half).argmax(axis=1)
    return out


def _matrix(column: pa.Array | pa.ChunkedArray, size: int) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.float64).reshape(-1, size)


def _assign(centres: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = _matrix(batch.column("vector"), centres.shape[1])
            own = nearest(x, centres)
            spread = ((x - centres[own]) ** 2).sum(axis=1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(own), pa.array(spread)], [*batch.schema.names, "list", "spread"]
            )

    return run


def _pack(turn: np.ndarray):
    """One row for a block: ids, original vectors, rotated vectors by column blocks."""
    size = len(turn)

    def run(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values("rep", kind="stable")
        x = np.array(part["vector"].tolist(), np.float64).reshape(-1, size)
        y = x @ turn
        ids = part["ids"].tolist()
        return pd.DataFrame({
            "list": part["list"].iloc[:1].values, "block": part["block"].iloc[:1].values,
            "n": [len(x)], "ids": [[int(i) for own in ids for i in own]],
            "of": [[k for k, own in enumerate(ids) for _ in own]], "vectors": [x.tobytes()],
            "columns": [[y[:, at : at + COLUMNS].tobytes() for at in range(0, size, COLUMNS)]],
        })

    return run


_PACKED = "list long, block long, n long, ids array<long>, of array<long>, vectors binary, columns array<binary>"


def allowed(d: int, size: int) -> float:
    """The part of a squared distance that d columns may hold. After a random rotation that part
    has a beta distribution, with mean d / size."""
    return d / size + ERROR * (2 * d * (size - d) / (size * size * (size + 2))) ** 0.5


def survivors(q: np.ndarray, columns: list[np.ndarray], norms: np.ndarray, threshold: np.ndarray) -> tuple:
    """Pairs (query, vector) that no hypothesis test refutes. q: rotated queries; threshold: the
    least score of each that matters, which with the norms bounds a candidate's distance."""
    size, lengths = q.shape[1], (q**2).sum(axis=1)
    with np.errstate(invalid="ignore", over="ignore"):
        limit = lengths[:, None] + norms[None, :] - 2 * threshold[:, None]
        first, d = columns[0], columns[0].shape[1]
        head = q[:, :d]
        seen = (head**2).sum(axis=1)[:, None] + (first**2).sum(axis=1)[None, :] - 2 * head @ first.T
        # a vector at the threshold itself may stand above its limit by rounding
        slack = 1e-9 * (lengths[:, None] + norms[None, :])
        if d == size:
            return np.nonzero(~(seen > limit + slack))
        a, b = np.nonzero(~(seen > limit * allowed(d, size) + slack))
        seen, limit, slack = seen[a, b], limit[a, b], slack[a, b]
        for block in columns[1:]:
            low, d = d, d + block.shape[1]
            if d == size:
                break  # all columns: the exact score decides
            seen = seen + ((q[a, low:d] - block[b]) ** 2).sum(axis=1)
            stays = ~(seen > limit * allowed(d, size) + slack)
            a, b, seen, limit, slack = a[stays], b[stays], seen[stays], limit[stays], slack[stays]
    return a, b


def inner(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Inner products row by row, summed from the first component to the last."""
    out = np.zeros(len(x))
    for k in range(x.shape[1]):
        out += x[:, k] * y[:, k]
    return out


def _scan(turn: np.ndarray, most: int):
    """The `most` best of a block for each query."""
    size = len(turn)
    names = ["query", "vec_id", "score"]

    def run(queries: pd.DataFrame, block: pd.DataFrame) -> pd.DataFrame:
        if queries.empty or block.empty:
            return pd.DataFrame({c: [] for c in names})
        x = np.frombuffer(block["vectors"].iat[0]).reshape(-1, size)
        ids = np.array(block["ids"].iat[0], np.int64)
        count = np.bincount(np.array(block["of"].iat[0], np.int64), minlength=len(x))
        begin = np.cumsum(count) - count
        columns = [np.frombuffer(c).reshape(len(x), -1) for c in block["columns"].iat[0]]
        norms = (x**2).sum(axis=1)
        found = []
        for at in range(0, len(queries), CHUNK):
            part = queries.iloc[at : at + CHUNK]
            q = np.array(part["vector"].tolist(), np.float64).reshape(-1, size)
            least = part["threshold"].to_numpy(np.float64)
            a, b = survivors(q @ turn, columns, norms, least)
            for low in range(0, len(a), 1 << 16):
                # pairs in slices of whole queries would do as well; what is kept is cut below
                i, j = a[low : low + (1 << 16)], b[low : low + (1 << 16)]
                score = inner(q[i], x[j])
                good = ~(score < least[i])
                i, j, score = i[good], j[good], score[good]
                own = np.repeat(np.arange(len(i)), count[j])
                nth = np.arange(len(own)) - np.repeat(np.cumsum(count[j]) - count[j], count[j])
                found.append(_best(part["query"].to_numpy()[i[own]], ids[begin[j[own]] + nth], score[own], most))
        out = _best(*[np.concatenate(c) for c in zip(*found, strict=True)], most) if found else None
        if out is None or not len(out[0]):
            return pd.DataFrame({c: [] for c in names})
        return pd.DataFrame(dict(zip(names, out, strict=True)))

    return run


def _best(query: np.ndarray, ids: np.ndarray, score: np.ndarray, most: int) -> tuple:
    """Of each query the `most` rows of highest score, ties to the smaller id."""
    by = np.lexsort((ids, -score, query))
    query, ids, score = query[by], ids[by], score[by]
    new = np.append(True, query[1:] != query[:-1]) if len(query) else np.zeros(0, bool)
    begin = np.flatnonzero(new)
    nth = np.arange(len(query)) - np.repeat(begin, np.diff(np.append(begin, len(query))))
    keep = nth < most
    return query[keep], ids[keep], score[keep]


def tail(z: np.ndarray) -> np.ndarray:
    """The normal distribution's upper tail (Abramowitz and Stegun, 26.2.17)."""
    a = np.abs(z)
    t = 1 / (1 + 0.2316419 * a)
    series = t * (0.319381530 + t * (-0.356563782 + t * (1.781477937 + t * (-1.821255978 + t * 1.330274429))))
    out = np.exp(-a * a / 2) / np.sqrt(2 * np.pi) * series
    return np.where(z >= 0, out, 1 - out)


def _probes(centres: np.ndarray, sizes: np.ndarray, spread: np.ndarray, k: int, missed: float):
    """(query, vector, threshold, list) of the lists to probe. sizes: ids in a list; spread: the
    standard deviation of one component around the centroid."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("vector"), centres.shape[1])
            least = batch.column("threshold").to_numpy(zero_copy_only=False)
            for at in range(0, len(q), CHUNK):
                part, low = q[at : at + CHUNK], least[at : at + CHUNK]
                sd = np.sqrt((part**2).sum(axis=1))[:, None] * spread[None, :]
                with np.errstate(invalid="ignore", divide="ignore"):
                    z = (low[:, None] - part @ centres.T) / np.maximum(sd, 1e-300)
                    hits = sizes * tail(np.clip(np.nan_to_num(z, nan=-40.0), -40, 40))
                order = np.argsort(-hits, axis=1, kind="stable")
                ordered = np.take_along_axis(hits, order, axis=1)
                left = ordered[:, ::-1].cumsum(axis=1)[:, ::-1]  # expected here and in all after
                probed = left > missed * k
                probed[:, 0] = True
                row, nth = np.nonzero(probed & (np.take_along_axis(np.broadcast_to(sizes, hits.shape), order, axis=1) > 0))
                rows = batch.slice(at, len(part)).take(pa.array(row))
                yield pa.RecordBatch.from_arrays(
                    [rows.column("query"), rows.column("vector"), rows.column("threshold"), pa.array(order[row, nth])],
                    ["query", "vector", "threshold", "list"],
                )

    return run


def search(
    docs: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding", k: int = K,
    query_every: int = QUERY_EVERY, missed: float = MISSED, most_lists: int = MOST_LISTS,
) -> DataFrame:
    """The k rows of largest inner product for each row whose id query_every divides.

    Returns query_id, rank (from 1), vec_id and score (the inner product of the original vectors
    in double precision), ties to the smaller id; all candidates where there are fewer than k. A
    row is no candidate of its own id. Neighbours are approximate: see MISSED and ERROR.

    Rows without an id, and vectors that are null, empty, zero, or hold null or non-finite
    components take no part; nor do those of another length than most have (of lengths equally
    common: the longest). Of rows that share an id, one stands for it: that of the least vector.
    Ids of equal vectors are all found, each for the others, too. Empty tables give no rows. Other
    columns are neither read nor returned.
    """
    spark = docs.sparkSession
    given = docs.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vector_col}`").cast("array<double>").alias("vector"))
    given = given.where(F.col("vec_id").isNotNull() & usable(F.col("vector")))
    nothing = spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    lengths = given.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), F.desc("size")).first()
    if lengths is None:
        return nothing
    size = lengths["size"]
    # adding 0.0 makes one zero of two, so that equal vectors are equal as keys
    same = F.transform("vector", lambda x: x + F.lit(0.0))
    rows = given.where(F.size("vector") == size).groupBy("vec_id").agg(F.min(same).alias("vector"))
    rows = written(rows, "vectors")
    nth = F.row_number().over(Window.partitionBy("vector").orderBy("vec_id"))
    least = rows.withColumn("nth", nth).where(F.col("nth") <= k + 1)
    classes = least.groupBy("vector").agg(F.array_sort(F.collect_list("vec_id")).alias("ids"))
    classes = written(classes.select(F.col("ids")[0].alias("rep"), "vector", "ids"), "vector-classes")

    n = classes.count()
    lists = max(1, min(most_lists, round(n**0.5 / 2)))
    drawn = classes.orderBy(F.xxhash64("rep"), "rep").limit(lists * SAMPLE_PER_LIST).select("vector")
    sample = _matrix(drawn.toArrow().column("vector"), size)
    with np.errstate(over="ignore", invalid="ignore"):
        centres, turn = np.nan_to_num(fit(sample, lists)), rotation(size)
    dealt = classes.mapInArrow(_assign(centres), "rep long, vector array<double>, ids array<long>, list long, spread double")
    dealt = written(dealt, "dealt-vectors")
    stats = dealt.groupBy("list").agg(
        F.count(F.lit(1)).alias("n"), F.sum(F.size("ids")).alias("ids"), F.sum("spread").alias("spread")
    ).collect()  # a row for each list
    sizes, spread, blocks = np.zeros(len(centres)), np.zeros(len(centres)), [1] * len(centres)
    for s in stats:
        sizes[s["list"]], spread[s["list"]] = s["ids"], (s["spread"] / s["n"] / size) ** 0.5
        blocks[s["list"]] = -(-s["n"] // BLOCK)
    of_list = F.get(F.lit(np.array(blocks, np.int64)), F.col("list").cast("int"))
    index = dealt.withColumn("block", F.pmod(F.xxhash64("rep"), of_list)).select("rep", "vector", "ids", "list", "block")
    index = written(index.groupBy("list", "block").applyInPandas(_pack(turn), _PACKED), "vector-index")

    asked = rows.where(F.col("vec_id") % query_every == 0)
    queries = written(asked.groupBy("vector").agg(F.min("vec_id").alias("query")), "query-vectors")
    # the first look: a list with enough ids, as near as can be
    enough = np.where(sizes >= min(3 * (k + 1), sizes.max()))[0]
    near = queries.withColumn("threshold", F.lit(float("-inf"))).mapInArrow(
        _nearest_of(centres, enough), "query long, vector array<double>, threshold double, list long"
    )
    near = written(near.withColumn("block", F.pmod(F.xxhash64("query"), of_list)), "first-looks")
    hits = "query long, vec_id long, score double"
    seen = written(_met(near, index, len(centres), _scan(turn, k + 1), hits), "first-found")
    looked = seen.groupBy("query").agg(F.count(F.lit(1)).alias("n"), F.min("score").alias("threshold"))
    known = queries.join(looked.where(F.col("n") == k + 1), "query", "left").select(
        "query", "vector", F.coalesce("threshold", F.lit(float("-inf"))).alias("threshold")
    )
    known = written(known, "query-thresholds")
    probes = known.mapInArrow(
        _probes(centres, sizes, spread, k, missed), "query long, vector array<double>, threshold double, list long"
    )
    probes = written(probes, "probes")
    each = probes.withColumn("block", F.explode(F.sequence(F.lit(0).cast("long"), of_list - 1)))
    found = written(_met(each, index, len(centres), _scan(turn, k + 1), hits, probes), "found-neighbours")
    # what the first look found counts, even where a test gave it up
    every = found.unionAll(seen).groupBy("query", "vec_id").agg(F.max("score").alias("score"))

    best = Window.partitionBy("query").orderBy(F.desc("score"), "vec_id")
    top = every.withColumn("nth", F.row_number().over(best)).where(F.col("nth") <= k + 1)
    top = top.groupBy("query").agg(F.array_sort(F.collect_list(F.struct((-F.col("score")).alias("minus"), "vec_id"))).alias("found"))
    # all ids of a query's vector get what the vector has found, but for themselves
    ids = asked.join(queries.select("vector", "query"), "vector").select(F.col("vec_id").alias("query_id"), "query")
    own = ids.join(top, "query").select(
        "query_id",
        F.slice(F.filter("found", lambda x: x["vec_id"] != F.col("query_id")), 1, k).alias("found"),
    )
    out = own.select("query_id", F.posexplode("found").alias("at", "one"))
    out = written(out.select(
        "query_id", (F.col("at") + 1).alias("rank"), F.col("one.vec_id").alias("vec_id"), (-F.col("one.minus")).alias("score")
    ), "neighbours")
    discard(rows, classes, dealt, index, queries, near, seen, known, probes, found)
    return out


def _met(probes: DataFrame, index: DataFrame, lists: int, scan, schema: str, counted: DataFrame | None = None) -> DataFrame:
    """Queries scan the blocks of their lists. Where a list has many queries they are dealt into
    parts, and each part gets the list's blocks."""
    parts = np.ones(lists, np.int64)
    for at, n in (counted or probes).groupBy("list").count().collect():  # a row for each list
        parts[at] = -(-n // QUERIES)
    of_list = F.get(F.lit(parts), F.col("list").cast("int"))
    asked = probes.withColumn("part", F.pmod(F.xxhash64("query"), of_list)).groupBy("list", "block", "part")
    blocks = index.withColumn("part", F.explode(F.sequence(F.lit(0).cast("long"), of_list - 1)))
    return asked.cogroup(blocks.groupBy("list", "block", "part")).applyInPandas(scan, schema)


def _nearest_of(centres: np.ndarray, of: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            q = _matrix(batch.column("vector"), centres.shape[1])
            yield pa.RecordBatch.from_arrays(
                [batch.column("query"), batch.column("vector"), batch.column("threshold"), pa.array(of[nearest(q, centres[of])])],
                ["query", "vector", "threshold", "list"],
            )

    return run


def digest(embeddings: DataFrame) -> DataFrame:
    return search(embeddings.select("vec_id", "embedding"))
