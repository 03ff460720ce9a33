"""N-gram Jaccard join by PartEnum signatures, down to components of linked documents.

Documents of equal shingle sets form a class; classes, each by its least id, are joined.

1. A shingle that no other class has lowers what a class can share with any other. Classes
   that are left with too little to reach the threshold link with nothing and go no further.
   Half of the domain is looked at, the other half counts as shared: shingles are dealt by their
   hash, by the million in one row, so that it is known of each whether another class has it,
   at any size of the corpus.
2. Sizes are cut into bands of ratio 1 / threshold. Two similar sets lie in one band or in
   neighbouring ones and differ in at most k elements, k fixed by the band. The domain is
   dealt into first-level partitions, so many that the sets differ by at most `SLACK` in one
   of them, and each of these into parts. Every choice of parts that leaves out SLACK of them
   gives a signature: the hash of the elements in the parts chosen. Similar sets share one.
3. In each signature's bucket, the most central member (the one with the fewest shingles of
   its own) is compared with the others: a star, not all pairs. Components follow.
4. Members of a bucket that are in different components still are compared as pairs where
   they could reach the threshold: where bounds on what they share leave room for it, from 1
   and from counts of their shingles by how common these are. No link between components is
   lost; links within a component are not looked for.

Comparisons are exact, on the texts. Shingles are known by 64-bit hashes.
"""

from __future__ import annotations

import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm import symbols
from shelfmetrics.llm.common import Carried, discard, worker_cache, written
from shelfmetrics.llm.repeats import Documents, bitmap, chosen, hash_column, id_hashes, in_bitmap
from shelfmetrics.llm.symbols import BLANK, LOWER, U, mix

SHINGLE = 4
PERCENT = 85
SLACK = 1
PARTS = 3
#: Bitmaps of ids get so many times the usual room: a row let through in excess costs a whole text.
SPARSE = 8
#: Documents are dealt in groups of about so many shingles, and of so many documents at most (their
#: places take 16 bits), into buckets of about so many shingles.
GROUP_SHINGLES, GROUP_DOCS, BUCKET_SHINGLES = 1 << 19, 1 << 16, 1 << 20


def shingle_sets(batch: pa.RecordBatch, size: int) -> Iterator[tuple]:
    """(rows, list of sets) of a batch with a column text; a set is a sorted array of hashes."""
    worker_cache("ngram")
    for part, raw, offsets in symbols.slices(batch, "text"):
        raw = LOWER[raw]
        start, end, first = symbols.words(raw, offsets, BLANK)
        h = symbols.hashes(raw, start, end)
        sums = symbols.prefix(h) if len(h) <= symbols.CHUNK else None
        sets = []
        for k in range(part.num_rows):
            lo, hi = int(first[k]), int(first[k + 1])
            if lo == hi:
                sets.append(np.zeros(0, U))
                continue
            own, base = (sums, 0) if sums is not None else (symbols.prefix(h[lo:hi]), lo)
            at = np.arange(lo, max(lo + 1, hi - size + 1)) - base
            sets.append(np.unique(symbols.stretches(own, at, np.minimum(at + size, hi - base))))
        yield part, sets


def _set_hashes(size: int, names: list[str]):
    """Rows (the columns named) with id, n and two hashes of the set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, sets in shingle_sets(batch, size):
                sums = [int(mix(s).sum(dtype=U)) for s in sets]
                others = [int(mix(s ^ U(0x5851F42D4C957F2D)).sum(dtype=U)) for s in sets]
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        part.column("id"),
                        pa.array([len(s) for s in sets], pa.int64()),
                        pa.array(np.array(sums, U).view(np.int64)),
                        pa.array(np.array(others, U).view(np.int64)),
                    ],
                    [*names, "id", "n", "s1", "s2"],
                )

    return run


def _in_classes(bits, inside: bool):
    """The rows whose set's hash is in a bitmap, or those whose is not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            own = in_bitmap(bits.value, batch.column("s1").to_numpy().view(np.uint64)) == inside
            if own.any():
                yield batch if own.all() else batch.filter(pa.array(own))

    return run


def reaches(shared, x, y, percent: int):
    """Whether sets of sizes x and y that share so many elements are similar."""
    return shared * (100 + percent) >= percent * (x + y)


def bands(most: int, percent: int) -> list[int]:
    """Least sizes of the bands, up to the one that holds `most`."""
    out = [1]
    while out[-1] <= most:
        out.append(max(out[-1] + 1, -(-out[-1] * 100 // percent)))
    return out


def signatures(shingles: np.ndarray, percent: int) -> np.ndarray:
    """The set's PartEnum signatures, for its own band and the next."""
    n = len(shingles)
    starts = bands(n * 2 + 2, percent)
    own = int(np.searchsorted(starts, n, "right")) - 1
    out = []
    for instance in (own, own + 1):
        # sizes in this instance stay below the end of its band
        end = starts[instance + 1] - 1
        k = (100 - percent) * 2 * end // (100 + percent)
        if k == 0:
            continue  # similar sets of these sizes are equal
        slack = min(SLACK, k)
        first_level = -(-(k + 1) // (slack + 1))
        h = mix(shingles + U(instance))
        part = (h >> U(33)) % U(first_level) * U(PARTS) + (h & U(0xFFFFFF)) % U(PARTS)
        sums = np.zeros(first_level * PARTS, U)
        np.add.at(sums, part.astype(np.int64), mix(h))
        sums = sums.reshape(first_level, PARTS)
        for choice in itertools.combinations(range(PARTS), PARTS - slack):
            value = sums[:, list(choice)].sum(axis=1, dtype=U)
            label = (np.arange(first_level) * 64 + sum(1 << c for c in choice)).astype(U)
            out.append(mix(value + mix(label + U(instance << 40))))
    return np.concatenate(out) if out else np.zeros(0, U)


def _dealt_group(ids: list[int], sets: list[np.ndarray], buckets: int) -> pa.RecordBatch:
    """A row for each bucket that the shingles of a group of documents fall into: hashes and the places
    of their documents in the group. Bucket 0 has a row in any case, which brings the documents:
    their ids, how many shingles they have, and how many of them were dealt."""
    own = [s[s & U(1) == 0] for s in sets]
    dealt = np.array([len(s) for s in own], np.int64)
    every = np.concatenate(own)
    bucket = ((every >> U(33)) * U(buckets)) >> U(31)
    order = np.argsort(bucket.astype(np.uint16 if buckets <= 1 << 16 else np.uint32), kind="stable")
    hashes = ((every >> U(1)) & U(0xFFFFFFFF)).astype("<u4")[order]
    docs = np.repeat(np.arange(len(own)), dealt).astype("<u2")[order]
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=U))
    full = np.flatnonzero(np.diff(cuts))
    full = full if len(full) and full[0] == 0 else np.append(0, full)
    known = np.stack([np.array(ids, np.int64), np.array([len(s) for s in sets], np.int64), dealt]).astype("<i8")
    key = int(mix(mix(known[0].astype(U)) + np.arange(len(ids), dtype=U)).sum(dtype=U).view(np.int64))
    spans = [(int(cuts[k]), int(cuts[k + 1])) for k in full]
    return pa.RecordBatch.from_arrays(
        [
            pa.array(full, pa.int64()),
            pa.array(np.full(len(full), key), pa.int64()),
            pa.array([known.tobytes(), *[None] * (len(full) - 1)], pa.binary()),
            pa.array([hashes[x:y].tobytes() for x, y in spans], pa.binary()),
            pa.array([docs[x:y].tobytes() for x, y in spans], pa.binary()),
        ],
        ["bucket", "group", "known", "hashes", "docs"],
    )


def _dealt(size: int, reps, buckets: int):
    """The shingles of classes, in groups of documents, dealt into buckets by hash."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, held, count = [], [], 0
        for batch in chosen(reps, True)(batches):
            for part, sets in shingle_sets(batch, size):
                for k, s in zip(part.column("id").to_pylist(), sets, strict=True):
                    if not len(s):
                        continue
                    ids.append(k)
                    held.append(s)
                    count += len(s)
                    if count >= GROUP_SHINGLES or len(ids) == GROUP_DOCS:
                        yield _dealt_group(ids, held, buckets)
                        ids, held, count = [], [], 0
        if ids:
            yield _dealt_group(ids, held, buckets)

    return run


def _met_again(block: pa.Table) -> pa.Table:
    """Of a bucket the places of documents, one for each shingle that is there more than once."""
    parts = [np.frombuffer(x, "<u4") for x in block.column("hashes").to_pylist()]
    every = np.concatenate(parts)
    order = np.argsort(every)
    equal = np.diff(every[order]) == 0
    again = np.zeros(len(every), bool)
    again[order[1:][equal]] = True
    again[order[:-1][equal]] = True
    cuts = np.cumsum([0, *(len(x) for x in parts)])
    docs = []
    for x, a, b in zip(block.column("docs").to_pylist(), cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        docs.append(np.frombuffer(x, "<u2")[again[a:b]].tobytes())
    told = pa.array([bool(x) for x in docs])
    out = pa.table([block.column("group"), block.column("known"), pa.array(docs, pa.binary())], ["group", "known", "docs"])
    return out.filter(pc.or_(block.column("known").is_valid(), told))


def _able(percent: int):
    """(id, m) of the classes of a group that can reach the threshold; m shingles may be shared."""

    def run(block: pa.Table) -> pa.Table:
        known = next(x for x in block.column("known").to_pylist() if x is not None)
        ids, n, dealt = np.frombuffer(known, "<i8").reshape(3, -1)
        again = np.concatenate([np.frombuffer(x, "<u2") for x in block.column("docs").to_pylist()])
        m = np.minimum(n, n - dealt + np.bincount(again, minlength=len(ids)))
        # a partner holds m elements at least, and at best no others
        keep = reaches(m, n, m, percent)
        return pa.table([pa.array(ids[keep], pa.int64()), pa.array(m[keep], pa.int64())], ["id", "m"])

    return run


def able(texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, n, m) of the classes that can reach the threshold with any other."""
    known = classes.where("n > 0")
    number, total = known.agg(F.count(F.lit(1)), F.coalesce(F.sum("n"), F.lit(0))).first()
    buckets = max(1, -(-int(total) // (2 * BUCKET_SHINGLES)))
    reps = bitmap(known.select("id"), id_hashes, 1, SPARSE * number)
    dealt = texts.mapInArrow(_dealt(size, reps, buckets), "bucket long, group long, known binary, hashes binary, docs binary")
    again = dealt.groupBy("bucket").applyInArrow(_met_again, "group long, known binary, docs binary")
    found = again.groupBy("group").applyInArrow(_able(percent), "id long, m long")
    found = written(found.groupBy("id").agg(F.max("m").alias("m")).join(known.select("id", "n"), "id"), "able-classes")
    reps.release()
    return found.select("id", "n", "m")


def _signature_rows(size: int, percent: int, wanted):
    """(sig, id) of the documents whose id is in a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chosen(wanted, True)(batches):
            for part, sets in shingle_sets(batch, size):
                found = [signatures(s, percent) if len(s) else np.zeros(0, U) for s in sets]
                ids = np.repeat(part.column("id").to_numpy(), [len(x) for x in found])
                every = np.concatenate(found).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(ids, pa.int64())], ["sig", "id"])

    return run


def _similar(size: int, percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                rows = batch.slice(at, 500)
                sides = []
                for name in ("text_a", "text_b"):
                    one = pa.RecordBatch.from_arrays([rows.column(name)], ["text"])
                    sides.append([s for _, sets in shingle_sets(one, size) for s in sets])
                keep = [
                    reaches(len(np.intersect1d(x, y, assume_unique=True)), len(x), len(y), percent)
                    for x, y in zip(*sides, strict=True)
                ]
                yield rows.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    return run


def verified(pairs: DataFrame, texts: DataFrame, size: int, percent: int, name: str) -> DataFrame:
    """The pairs (a, b) whose sets are similar, each compared in full."""
    wanted = bitmap(pairs.select("a").unionAll(pairs.select("b")), id_hashes, 1, SPARSE * 2 * pairs.count())
    own = texts.mapInArrow(chosen(wanted, True), "id long, text string").dropDuplicates(["id"])
    own = written(own, "candidate-texts")
    wanted.release()
    both = pairs.join(own.select(F.col("id").alias("a"), F.col("text").alias("text_a")), "a")
    both = both.join(own.select(F.col("id").alias("b"), F.col("text").alias("text_b")), "b")
    both = both.select("a", "b", "text_a", "text_b")
    out = written(both.mapInArrow(_similar(size, percent), "a long, b long"), name)
    discard(own)
    return out


def components(edges: DataFrame) -> DataFrame:
    """(id, label): the least id that each id of edges (a, b) can reach.

    In each round a node and all its neighbours are tied to the least of them, until nothing
    changes and all edges lead to the least of their component. A node's neighbours are never
    gathered, only their least; every round is a written table.
    """

    def state(e: DataFrame) -> tuple:
        return tuple(e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())

    ordered = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    e = written(ordered.where("a > b").distinct(), "edges")
    now, before = state(e), None
    while now[0] and now != before:
        both = e.unionAll(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("l")).select("a", F.least("a", "l").alias("l"))
        least = written(least, "least")
        tied = both.join(least, "a").select(F.col("b").alias("a"), F.col("l").alias("b")).unionAll(
            least.select("a", F.col("l").alias("b"))
        )
        old, e = e, written(tied.where("a > b").distinct(), "edges")
        discard(old, least)
        now, before = state(e), now
    return written(e.groupBy("a").agg(F.min("b").alias("label")).select(F.col("a").alias("id"), "label"), "labels")


def _shingle_rows(size: int, bits):
    """(shingle, id) of the texts whose id is in a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in chosen(bits, True)(batches):
            for part, sets in shingle_sets(batch, size):
                ids = np.repeat(part.column("id").to_numpy(), [len(s) for s in sets])
                every = np.concatenate(sets).view(np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(every), pa.array(ids, pa.int64())], ["shingle", "id"])

    return run


def profiles(ids: DataFrame, texts: DataFrame, size: int) -> DataFrame:
    """(id, profile): how many of a document's shingles fall into each of 64 parts of the domain,
    which go by how many of the given documents have the shingle, and by hash. Shingles that no
    other of them has are in no part. Two sets share at most what both have in each part."""
    bits = bitmap(ids, id_hashes, 1, SPARSE * ids.count())
    rows = texts.mapInArrow(_shingle_rows(size, bits), "shingle long, id long").distinct()
    rows = written(rows, "open-shingles")
    counts = written(rows.groupBy("shingle").agg(F.count(F.lit(1)).alias("docs")).where("docs > 1"), "shingle-counts")
    rank = sum((F.col("docs") >= least).cast("int") for least in (4, 16, 64))
    part = rank * 16 + F.pmod("shingle", F.lit(16)).cast("int")
    sizes = rows.join(counts, "shingle").groupBy("id", part.alias("part")).agg(F.count(F.lit(1)).cast("int").alias("n"))
    entries = F.map_from_entries(F.collect_list(F.struct("part", "n")))
    profile = F.transform(F.sequence(F.lit(0), F.lit(63)), lambda k: F.coalesce(F.try_element_at("entries", k), F.lit(0)))
    out = sizes.groupBy("id").agg(entries.alias("entries")).select("id", profile.alias("profile"))
    out = written(out, "profiles")
    discard(rows, counts)
    bits.release()
    return out


def _sum(counts: str | Column) -> Column:
    return F.aggregate(counts, F.lit(0), lambda total, n: total + n)


def _overlap(a: str, b: str, percent: int) -> Column:
    """Whether profiles leave room for the threshold."""
    shared = _sum(F.zip_with(f"{a}.profile", f"{b}.profile", lambda x, y: F.least(x, y)))
    return shared * (100 + percent) >= (F.col(f"{a}.n") + F.col(f"{b}.n")) * percent


def _could(a: str, b: str, percent: int) -> Column:
    m, n = F.least(f"{a}.m", f"{b}.m"), F.col(f"{a}.n") + F.col(f"{b}.n")
    return m * (100 + percent) >= n * percent


def link_labels(texts: DataFrame, classes: DataFrame, size: int, percent: int) -> DataFrame:
    """(id, label) of the classes that are similar to others: the least id they can reach."""
    known = able(texts, classes, size, percent)
    wanted = bitmap(known.select("id"), id_hashes, 1, SPARSE * known.count())
    rows = texts.mapInArrow(_signature_rows(size, percent, wanted), "sig long, id long")
    rows = written(rows.dropDuplicates(["sig", "id"]).join(known, "id").select("sig", "id", "n", "m"), "signatures")
    wanted.release()
    central = F.struct((F.col("m") / F.col("n")).alias("part"), (-F.col("id")).alias("minus"), "id", "n", "m")
    buckets = rows.groupBy("sig").agg(F.max(central).alias("hub"), F.min("id").alias("low"), F.max("id").alias("high"))
    buckets = written(buckets.where("low < high").select("sig", "hub"), "buckets")
    stars = rows.alias("x").join(buckets.alias("y"), "sig").where("x.id <> hub.id").where(_could("x", "hub", percent))
    stars = written(stars.select(F.col("x.id").alias("a"), F.col("hub.id").alias("b")).distinct(), "star-pairs")
    links = verified(stars, texts, size, percent, "star-links")

    # what stars have left: members of one bucket in different components
    labels = components(links)
    own = rows.join(buckets.select("sig"), "sig").join(labels, "id", "left").withColumn("label", F.coalesce("label", "id"))
    own = written(own, "labelled-rows")
    mixed = own.groupBy("sig").agg(
        F.min("label").alias("low"), F.max("label").alias("high"), F.min("n").alias("n")
    )
    mixed = written(mixed.where("low < high").select("sig", F.col("n").alias("least")), "mixed-buckets")
    # one that could reach the threshold with no member of the bucket is left out of it
    best = F.col("m") * (100 + percent) >= percent * (F.col("n") + F.greatest("least", "m"))
    open_rows = written(own.join(mixed, "sig").where(best).drop("least"), "open-rows")
    open_rows = open_rows.join(profiles(open_rows.select("id"), texts, size), "id")
    open_rows = written(open_rows.where(_sum("profile") * (100 + percent) >= percent * F.col("n")), "profiled-rows")
    pairs = (
        open_rows.alias("x")
        .join(open_rows.alias("y"), F.col("x.sig") == F.col("y.sig"))
        .where((F.col("x.id") < F.col("y.id")) & (F.col("x.label") != F.col("y.label")) & _could("x", "y", percent) & _overlap("x", "y", percent))
        .select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))
        .distinct()
    )
    tried = stars.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))
    pairs = written(pairs.join(tried, ["a", "b"], "left_anti"), "left-pairs")
    discard(rows, own, open_rows)
    if pairs.isEmpty():
        return labels
    return components(links.unionAll(verified(pairs, texts, size, percent, "left-links")))


def join_similar(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SHINGLE,
    percent: int = PERCENT, carry: list[str] | None = None,
) -> DataFrame:
    """Link documents whose shingle sets have a Jaccard similarity of percent / 100 or more.

    Returns per row of docs: `row` (the columns in carry; all by default), n_shingles,
    class_id (the least id with the same set) and component_id (the least id reachable by
    links). A text of fewer words than a shingle has one shingle of all its words; null and
    blank texts have none, link with nothing and are their own component. Rows without an id
    get no class or component; rows of an id whose text differs from the one that stands for
    it (see Documents) are their own component. Empty tables give no rows.
    """
    carried = Carried(docs, text_col, carry)
    documents = Documents(docs, id_col, text_col, carried.others)
    given = documents.rows.select("row", F.col(f"row.{id_col}").cast("long").alias("given"), "id", "text")
    packed = given.select(F.struct("row", "given").alias("row"), "id", "text")
    schema = packed.select(*carried.names, "id", *[F.lit(0).cast("long").alias(c) for c in ("n", "s1", "s2")]).schema
    sets = written(packed.mapInArrow(_set_hashes(size, carried.names), schema), "sets")
    known = sets.where("id is not null and n > 0")
    classes = known.groupBy("s1", "s2").agg(
        F.min("id").alias("id"), F.first("n").alias("n"), (F.min("id") < F.max("id")).alias("several")
    )
    classes = written(classes, "classes")
    labels = link_labels(documents.texts, classes, size, percent)
    # the others' rows are their own class and component: only rows of these are exchanged
    own = classes.join(labels, "id", "left").where("several or label is not null").select(
        F.col("s1").alias("k1"), F.col("s2").alias("k2"), F.col("id").alias("class_id"), F.coalesce("label", "id").alias("label")
    )
    own = written(own, "linked-classes")
    discard(classes, labels)
    bits = bitmap(own.select("k1"), hash_column, 1, own.count())
    linked = F.when(F.col("id").isNotNull() & (F.col("n") > 0), F.col("s1"))
    touched = sets.mapInArrow(_in_classes(bits, True), sets.schema).withColumn("k1", linked).withColumn("k2", F.col("s2"))
    touched = touched.join(own, ["k1", "k2"], "left")
    rest = sets.mapInArrow(_in_classes(bits, False), sets.schema)
    rest = rest.withColumns({c: F.lit(None).cast("long") for c in ("class_id", "label")})
    columns = [*sets.columns, "class_id", "label"]
    return touched.select(*columns).unionAll(rest.select(*columns)).select(
        carried.whole("row.row").alias("row"),
        F.col("n").alias("n_shingles"),
        F.coalesce("class_id", "row.given").alias("class_id"),
        F.coalesce("label", "row.given").alias("component_id"),
    )


def digest(docs: DataFrame) -> DataFrame:
    done = join_similar(docs.select("doc_id", "text"), carry=["doc_id"])
    return done.select(F.col("row.doc_id").alias("doc_id"), "n_shingles", "component_id")


ORACLE_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS (
  SELECT DISTINCT doc_id, array_to_string(list_slice(ws, i, i + 3), ' ') AS g
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 1) + 1)) AS i FROM w WHERE len(ws) > 0)
), n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS shared
  FROM s a JOIN s b ON a.g = b.g AND a.doc_id < b.doc_id GROUP BY ALL
), l AS (
  SELECT x, y FROM p JOIN n a ON a.doc_id = x JOIN n b ON b.doc_id = y
  WHERE 100 * shared >= 85 * (a.n + b.n - shared)
), e AS (SELECT x, y FROM l UNION ALL SELECT y, x FROM l),
r(doc_id, reached) AS (
  SELECT doc_id, doc_id FROM w
  UNION
  SELECT r.doc_id, e.y FROM r JOIN e ON e.x = r.reached
)
SELECT w.doc_id, coalesce(n, 0) AS n_shingles, c.component_id
FROM w LEFT JOIN n USING (doc_id)
JOIN (SELECT doc_id, min(reached) AS component_id FROM r GROUP BY doc_id) c USING (doc_id)
"""
