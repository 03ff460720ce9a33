"""Finding windows of L symbols that occur more than once, without moving all windows.

Of the k-grams in a window the one of least hash is the window's anchor (the leftmost of
equals). It depends on the window's content alone, so equal windows have equal anchors, at
the same distance. Consecutive windows mostly share their anchor; such a run, and the
stretch of text it covers, is a phrase. Every window lies in exactly one phrase.

1. Phrases are dealt by anchor, by the thousand in one row and equal ones of a task as one, to find
   those that occur more than once. Texts are searched again for these, and only these are rows of
   their own: a phrase with an earlier equal is settled as a whole, since it is equal windows
   throughout.
2. What is left are the borders of repeated passages: phrases without an earlier equal whose
   anchor occurs in other phrases, too. Their windows are looked at one by one.

Between passes the places to keep are sent as a bitmap, of 16 bits for each of them
and at most of a fixed size. It may let more through than asked for, never less; what comes
through in excess finds no partner. Where whole phrases hang on it, three bits each are looked at, so
that few come through in excess of a bitmap that is half full. Full bitmaps at very large inputs
cost rows, one for each phrase at most, not results.

Phrases are equal if their anchors and their contents have equal 64-bit hashes, over symbols that
depend on a key drawn for the run.

A phrase depends on its own text alone, not on how rows are dealt to tasks or batches, so
later passes meet the phrases of earlier ones again.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfmetrics.llm.common import discard, settled, written
from shelfmetrics.llm.symbols import BASE, U, grams, mix, prefix, slices, stretches

#: Bitmaps have 2^28 bits, 32 MB, at most; 2^SPARE for each element, if that is less.
SLOT_BITS, SPARE = 28, 4
#: Slots of one row while a bitmap is put together.
SHARD_BITS = 16
FLUSH = 1 << 20
#: Texts are searched in slices of so many bytes, and long ones in stretches of so many symbols: a
#: slice's arrays are a dozen times its symbols at eight bytes each.
SEARCH_BYTES, STEP = 1 << 19, 1 << 18
#: Phrases are dealt by so many at once into buckets of so many bytes of text: a worker holds the
#: arrays of either some ten times.
DEAL, BUCKET_BYTES = 1 << 18, 1 << 23
PLACE_BITS = 24

#: (bytes, offsets) of texts to (symbols, where each text's symbols begin).
Symbolise = Callable[[np.ndarray, np.ndarray], tuple[np.ndarray, np.ndarray]]


class Phrases:
    """The phrases of one stretch of symbols: arrays text, low (first window's start), count
    (windows), anchor, reach (from the first
    window's start to the anchor); sums are the stretch's prefix sums."""

    def __init__(self, sums: np.ndarray, first: np.ndarray, own: int, length: int, gram: int):
        """Windows that start before `own`, within texts that begin at first."""
        every = grams(sums, gram)
        low_bits = U((1 << PLACE_BITS) - 1)
        least = every & ~low_bits
        least |= np.arange(len(every), dtype=U)
        width, span = 1, length - gram + 1
        while 2 * width <= span:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        if width < span:
            least = np.minimum(least[: width - span], least[span - width :])
        least = least[:own]  # by window start; its place makes each gram's value its own
        new = np.ones(len(least), bool)
        new[1:] = least[1:] != least[:-1]
        new[first[first < len(new)]] = True
        begin = np.flatnonzero(new)
        text = np.searchsorted(first, begin, "right") - 1
        # windows lie within texts: a phrase ends where the next begins or the text's windows do
        end = np.minimum(np.append(begin[1:], len(new)), first[text + 1] - length + 1)
        valid = np.flatnonzero(begin < end)
        anchors = (least[begin[valid]] & low_bits).astype(np.int64)
        self.sums, self.length = sums, length
        self.text, self.low = text[valid], begin[valid]
        self.count = end[valid] - self.low
        self.anchor = every[anchors]
        self.reach = anchors - self.low

    def keep(self, chosen: np.ndarray) -> None:
        for name in ("text", "low", "count", "anchor", "reach"):
            setattr(self, name, getattr(self, name)[chosen])

    def content(self) -> np.ndarray:
        return stretches(self.sums, self.low, self.low + self.count - 1 + self.length)

    def windows(self) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, start) of every window."""
        phrase = np.repeat(np.arange(len(self.low)), self.count)
        within = np.arange(len(phrase)) - np.repeat(np.cumsum(self.count) - self.count, self.count)
        return phrase, self.low[phrase] + within


def phrases(batch: pa.RecordBatch, symbolise: Symbolise, length: int, gram: int) -> Iterator[tuple]:
    """(Phrases, ids, offset, (bytes, offsets, low)) of a batch (id, text), stretch by stretch:
    ids by text; the place of a symbol within its text is its place plus offset[text]; low is the
    stretch's place in the slice's symbols. Long texts are cut at multiples of STEP of their own symbols,
    with enough overlap that no window is lost."""
    for part, raw, offsets in slices(batch, "text", SEARCH_BYTES):
        symbols, first = symbolise(raw, offsets)
        ids = part.column("id").to_numpy()
        k, texts = 0, part.num_rows
        while k < texts:
            to = max(k + 1, int(np.searchsorted(first, first[k] + STEP, "right")) - 1)
            alone = to == k + 1
            for low in range(first[k], max(first[to] - length, first[k]) + 1, STEP if alone else len(symbols) + 1):
                high = min(first[to], low + STEP + length - 1) if alone else first[to]
                if high - low < length:
                    continue
                edges = np.clip(first[k : to + 1] - low, 0, high - low)
                own = STEP if alone else high - low
                found = Phrases(prefix(symbols[low:high]), edges, own, length, gram)
                if len(found.low):
                    yield found, ids[k:to], low - first[k:to], (raw, offsets, low)
            k = to


def slot(h: np.ndarray, bits: int) -> np.ndarray:
    return (h >> U(64 - bits)).astype(np.int64)


def slot_bits(elements: int) -> int:
    return min(SLOT_BITS, max(SHARD_BITS, max(1, elements).bit_length() + SPARE))


def place(ids: np.ndarray, low: np.ndarray) -> np.ndarray:
    return mix(mix(ids.astype(U)) + low.astype(U))


def in_bitmap(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    at = slot(h, len(bitmap).bit_length() + 2)  # 2^k bits in 2^(k - 3) bytes
    return (bitmap[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1


def probes(h: np.ndarray) -> list[np.ndarray]:
    """Three hashes out of one."""
    return [h, mix(h + U(BASE)), mix(h ^ U(BASE))]


def in_all(bitmap: np.ndarray, h: np.ndarray) -> np.ndarray:
    """in_bitmap() for a bitmap of probes()."""
    at = np.flatnonzero(in_bitmap(bitmap, h))
    for k in (1, 2):
        at = at[in_bitmap(bitmap, probes(h[at])[k])]
    out = np.zeros(len(h), bool)
    out[at] = True
    return out


def _slots(hashes, least: int, bits: int):
    """Slots of hashes(batch), by shard: those met once and those met more often in this task."""

    def rows(parts: list[np.ndarray]) -> Iterator[pa.RecordBatch]:
        slots, counts = np.unique(slot(np.concatenate(parts), bits), return_counts=True)
        several = counts >= least
        shard = slots >> SHARD_BITS
        cuts = np.flatnonzero(np.diff(shard, prepend=-1))
        within = (slots & ((1 << SHARD_BITS) - 1)).astype("<u2")
        columns: tuple[list, list, list] = ([], [], [])
        for a, b in zip(cuts.tolist(), [*cuts[1:].tolist(), len(slots)], strict=True):
            columns[0].append(int(shard[a]))
            columns[1].append(within[a:b][~several[a:b]].tobytes())
            columns[2].append(within[a:b][several[a:b]].tobytes())
        yield pa.RecordBatch.from_arrays(
            [pa.array(columns[0], pa.int32()), pa.array(columns[1], pa.binary()), pa.array(columns[2], pa.binary())],
            ["shard", "few", "several"],
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for h in hashes(batch):
                parts.append(h)
                size += len(h)
                if size >= FLUSH:
                    yield from rows(parts)
                    parts, size = [], 0
        if size:
            yield from rows(parts)

    return run


def _joined_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each shard the slots that several tasks have met, or one task several times."""
    shards: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for batch in batches:
        for shard, few, several in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            if shard not in shards:
                shards[shard] = (np.zeros(1 << SHARD_BITS, bool), np.zeros(1 << SHARD_BITS, bool))
            once, often = shards[shard]
            few = np.frombuffer(few, "<u2")
            often[few[once[few]]] = True
            once[few] = True
            often[np.frombuffer(several, "<u2")] = True
    for shard, (_, often) in shards.items():
        yield pa.RecordBatch.from_arrays(
            [pa.array([shard], pa.int32()), pa.array([np.packbits(often, bitorder="little").tobytes()], pa.binary())],
            ["shard", "bits"],
        )


class Bits:
    """A broadcast bitmap, packed on its way and on disk, and unpacked once in each worker."""

    def __init__(self, spark, bits: np.ndarray):
        self.packed, self.bits = spark.sparkContext.broadcast(zlib.compress(bits.tobytes(), 1)), None

    def __getstate__(self) -> dict:
        return {"packed": self.packed, "bits": None}

    @property
    def value(self) -> np.ndarray:
        if self.bits is None:
            self.bits = np.frombuffer(zlib.decompress(self.packed.value), np.uint8)
        return self.bits

    def release(self) -> None:
        """Free the executors' copies; a task that runs again fetches it again."""
        self.packed.unpersist()


def bitmap(rows: DataFrame, hashes, least: int, elements: int | None = None) -> Bits:
    """Broadcast bitmap of the slots of hashes(batch) of rows met at least `least` (1 or 2) times.
    Of each shard a row of fixed size reaches the driver, 2^SLOT_BITS bits in all at most; less if
    it is known how many elements there are."""
    spark = rows.sparkSession
    bits = SLOT_BITS if elements is None else slot_bits(elements)
    parts = rows.mapInArrow(_slots(hashes, least, bits), "shard int, few binary, several binary")
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    joined = parts.repartition(n, "shard").mapInArrow(_joined_slots, "shard int, bits binary")
    out = np.zeros((1 << (bits - SHARD_BITS), 1 << (SHARD_BITS - 3)), dtype=np.uint8)
    with settled(spark):
        shards = joined.toArrow()
    for shard, own in zip(*(c.to_pylist() for c in shards.columns), strict=True):
        out[shard] = np.frombuffer(own, np.uint8)
    return Bits(spark, out.ravel())


def hash_column(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield batch.column(0).to_numpy().view(np.uint64)


def _content_probes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    for h in hash_column(batch):
        yield np.concatenate(probes(h))


def _place_probes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    yield np.concatenate(probes(place(batch.column("id").to_numpy(), batch.column("low").to_numpy())))


#: What is dealt of a phrase; copies: 1, or 2 for more.
DEALT = {"anchor": "<u8", "content": "<u8", "id": "<i8", "low": "<i4", "copies": "u1"}


def _dealt_rows(parts: list[tuple], buckets: int) -> pa.RecordBatch:
    """A row for each bucket that phrases fall into; equal phrases are one, the least of them."""
    anchor, content, ids, low = (np.concatenate(x) for x in zip(*parts, strict=True))
    order = np.argsort(content, kind="stable")
    anchor, content, ids, low = anchor[order], content[order], ids[order], low[order]
    new = np.ones(len(order), bool)
    new[1:] = (content[1:] != content[:-1]) | (anchor[1:] != anchor[:-1])
    begin = np.flatnonzero(new)
    copies = np.minimum(np.diff(np.append(begin, len(order))), 2)
    values = [anchor[begin], content[begin], np.minimum.reduceat(ids, begin), np.minimum.reduceat(low, begin), copies]
    bucket = ((mix(values[0]) >> U(33)) * U(buckets)) >> U(31)
    # by document within buckets: neighbours are alike, which takes less room
    order = np.lexsort((values[2], bucket))
    cuts = np.searchsorted(bucket[order], np.arange(buckets + 1, dtype=U))
    full = np.flatnonzero(np.diff(cuts))
    columns = [pa.array(full, pa.int64())]
    for value, kind in zip(values, DEALT.values(), strict=True):
        value = value[order].astype(kind)
        columns.append(pa.array([value[x:y].tobytes() for x, y in zip(cuts[full], cuts[full + 1], strict=True)], pa.binary()))
    return pa.RecordBatch.from_arrays(columns, ["bucket", *DEALT])


def _dealt(args, buckets: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        parts, size = [], 0
        for batch in batches:
            for found, ids, offset, _ in phrases(batch, *args):
                parts.append((found.anchor, found.content(), ids[found.text], found.low + offset[found.text]))
                size += len(found.low)
                if size >= DEAL:
                    yield _dealt_rows(parts, buckets)
                    parts, size = [], 0
        if size:
            yield _dealt_rows(parts, buckets)

    return run


#: of `known`: phrases that occur more than once, with the least id and whether their anchor has other
#: contents; of `single`: the others whose anchor has; of `several`: such anchors, and how many contents.
MET = "kind string, a long, b long, c long, several boolean"


def _met(block: pa.Table) -> pa.Table:
    anchor, content, ids, low, copies = (
        np.concatenate([np.frombuffer(x, kind) for x in block.column(name).to_pylist()]) for name, kind in DEALT.items()
    )
    order = np.lexsort((content, anchor))
    anchor, content, ids, low = anchor[order], content[order], ids[order], low[order]
    new_anchor = np.ones(len(order), bool)
    new_anchor[1:] = anchor[1:] != anchor[:-1]
    new = new_anchor.copy()
    new[1:] |= content[1:] != content[:-1]
    begin = np.flatnonzero(new)
    often = np.add.reduceat(copies[order].astype(np.int64), begin) > 1
    of = np.cumsum(new_anchor[begin]) - 1
    contents = np.bincount(of)
    several = contents[of] > 1
    first = np.minimum.reduceat(ids, begin)
    single = np.flatnonzero(~often & several)
    anchors = anchor[begin][new_anchor[begin]]
    many = np.flatnonzero(contents > 1)
    parts = (
        ("known", anchor[begin][often], content[begin][often], first[often], several[often]),
        ("single", ids[begin][single], low[begin][single], low[begin][single], several[single]),
        ("several", anchors[many], contents[many], contents[many], contents[many] > 1),
    )
    kinds = pa.array([name for name, x, *_ in parts for _ in range(len(x))], pa.string())
    numbers = [pa.array(np.concatenate([p[k].astype(np.int64) for p in parts])) for k in (1, 2, 3)]
    return pa.table([kinds, *numbers, pa.array(np.concatenate([p[4] for p in parts]))], ["kind", "a", "b", "c", "several"])


def _phrases(args, known):
    """The phrases whose content is in a bitmap."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for found, ids, offset, _ in phrases(batch, *args):
                content = found.content()
                own = in_all(known.value, content)
                if not own.any():
                    continue
                found.keep(own)
                columns = [
                    found.anchor.view(np.int64),
                    content[own].view(np.int64),
                    ids[found.text],
                    found.low + offset[found.text],
                    found.count,
                ]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, pa.int64()) for c in columns], ["anchor", "content", "id", "low", "count"]
                )

    return run


class Repeats:
    """The first passes over texts (id, text), id never null, and what follows from them.

    within: whether a phrase is a repeat, too, if its text has an equal one before it. spans: tables
    (id, low, high) of what is settled; several: anchors of more than one content, with
    their number. Without `within`, of the phrases of one content in its first text the first
    stands for all; twins are tables (id, low, high, first) of the others, which share what is found
    for it.
    """

    def __init__(self, texts: DataFrame, symbolise: Symbolise, length: int, gram: int, within: bool):
        self.texts, self.args = texts, (symbolise, length, gram)
        self.spans: list[DataFrame] = []
        self.twins: list[DataFrame] = []
        size = texts.agg(F.coalesce(F.sum(F.octet_length("text").cast("long")), F.lit(0))).first()[0]
        buckets = max(1, size // BUCKET_BYTES)
        dealt = texts.mapInArrow(_dealt(self.args, buckets), ", ".join(["bucket long", *(f"{x} binary" for x in DEALT)]))
        self.met = written(dealt.groupBy("bucket").applyInArrow(_met, MET), "met-phrases", ["kind"])
        several = self.met.where("kind = 'several'")
        self.several = several.select(F.col("a").alias("anchor"), F.col("b").alias("contents"))
        content = ["anchor", "content"]
        known = self.met.where("kind = 'known'").select(
            F.col("a").alias("anchor"), F.col("b").alias("content"), F.col("c").alias("first"), "several"
        )
        bits = bitmap(known.select("content"), _content_probes, 1, known.count())
        schema = "anchor long, content long, id long, low long, count long"
        rows = texts.mapInArrow(_phrases(self.args, bits), schema)
        # the known side has each content once; exchanges on both sides of the join, so that
        # adaptive execution can split hot phrases
        high = F.col("low") + F.col("count") - 1 + length
        again = rows.join(known.hint("shuffle_hash"), content).select(
            *content, "id", "low", high.alias("high"), "first", "several"
        )
        again = written(again, "again")
        bits.release()
        self.spans.append(written(again.where("id > first").select("id", "low", "high"), "repeated"))
        own = again.where("id = first").drop("first")
        least = own.groupBy(*content, "id").agg(F.min("low").alias("first"), F.first("several").alias("several"))
        least = written(least, "least")
        rest = own.join(least.drop("id", "several").hint("shuffle_hash"), content).where(F.col("low") > F.col("first"))
        rest = written(rest.select("id", "low", "high", "first"), "rest")
        (self.spans if within else self.twins).append(rest)
        single = self.met.where("kind = 'single'").select(F.col("a").alias("id"), F.col("b").alias("low"))
        border = single.unionAll(least.where("several").select("id", F.col("first").alias("low")))
        self.places = bitmap(border, _place_probes, 1, border.count())
        discard(again, least)

    def last_pass(self, make, schema: str, name: str) -> DataFrame:
        """Rows of make(borders) over the texts, written; borders(batch) gives phrases() of the
        border phrases."""
        args, places = self.args, self.places

        def borders(batch: pa.RecordBatch) -> Iterator[tuple]:
            for found, ids, offset, source in phrases(batch, *args):
                at = place(ids[found.text], found.low + offset[found.text])
                found.keep(in_all(places.value, at))
                if len(found.low):
                    yield found, ids, offset, source

        out = written(self.texts.mapInArrow(make(borders), schema), name)
        places.release()
        return out


def together(tables: list[DataFrame]) -> DataFrame:
    out = tables[0]
    for more in tables[1:]:
        out = out.unionAll(more)
    return out


class Documents:
    """The rows of docs as texts (id, text) to search.

    Rows without an id are not searched, nor searched for. Of rows that share an id but differ
    in text, those with the least hash of the text stand for the document, the others are
    treated like rows without an id.
    """

    def __init__(self, docs: DataFrame, id_col: str, text_col: str, carry: list[str] | None):
        row = F.struct(*[F.col(c) for c in (docs.columns if carry is None else carry)])
        text = F.col(text_col).cast("string")
        version = F.xxhash64(F.coalesce(text, F.lit("")))
        ids = docs.select(F.col(id_col).cast("long").alias("id"), version.alias("version"))
        several = ids.where("id is not null").groupBy("id").agg(F.min("version").alias("least"), F.max("version").alias("most"))
        several = written(several.where("least < most").select("id", "least"), "id-versions")
        own = docs.select(row.alias("row"), F.col(id_col).cast("long").alias("id"), text.alias("text"))
        if not several.isEmpty():
            own = own.join(several, "id", "left")
            stands = F.col("least").isNull() | (F.xxhash64(F.coalesce("text", F.lit(""))) == F.col("least"))
            own = own.select("row", F.when(stands, F.col("id")).alias("id"), "text")
        self.rows = own
        self.texts = own.where("id is not null").select("id", "text")

    def with_spans(self, parts: list[DataFrame]) -> DataFrame:
        """Rows (row, text, spans); spans are the parts (id, low, high) of the row's id, joined where
        they touch, so there are no more than the text has gaps. Only texts that have spans are
        exchanged."""
        before = Window.partitionBy("id").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, -1)
        so_far = Window.partitionBy("id").orderBy("low", "high").rowsBetween(Window.unboundedPreceding, 0)
        reach = F.max("high").over(before)
        own = together([p.select("id", "low", "high") for p in parts])
        opened = own.withColumn("opens", (reach.isNull() | (F.col("low") > reach)).cast("int"))
        runs = opened.withColumn("run", F.sum("opens").over(so_far)).groupBy("id", "run")
        runs = runs.agg(F.min("low").alias("low"), F.max("high").alias("high"))
        spans = runs.groupBy("id").agg(F.collect_list(F.struct("low", "high")).alias("spans"))
        spans = written(spans, "spans")
        discard(*parts)
        some = bitmap(spans.select("id"), id_hashes, 1, spans.count())
        schema = self.rows.schema
        touched = self.rows.mapInArrow(chosen(some, True), schema).join(spans, "id", "left")
        rest = self.rows.mapInArrow(chosen(some, False), schema).withColumn("spans", F.lit(None).cast(spans.schema["spans"].dataType))
        none = F.array().cast("array<struct<low:bigint,high:bigint>>")
        both = touched.select("row", "text", "spans").unionAll(rest.select("row", "text", "spans"))
        return both.withColumn("spans", F.coalesce("spans", none))


def id_hashes(batch: pa.RecordBatch) -> Iterator[np.ndarray]:
    ids = batch.column(0).to_numpy()
    yield place(ids, np.zeros(len(ids), np.int64))


def chosen(bits: Bits, inside: bool):
    """The rows whose id is in a bitmap of ids, or those whose is not; without an id: not."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column("id")
            ids = column.fill_null(0).to_numpy()
            own = in_bitmap(bits.value, place(ids, np.zeros(len(ids), np.int64)))
            own &= column.is_valid().to_numpy(zero_copy_only=False)
            own = own == inside
            if own.all():
                yield batch
            elif own.any():
                yield batch.filter(pa.array(own))

    return run


def span_arrays(column: pa.Array) -> Iterator[np.ndarray]:
    """Rows (low, high) of each list of structs."""
    offsets = column.offsets.to_numpy()
    low, high = (column.values.field(n).to_numpy() for n in ("low", "high"))
    for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True):
        yield np.stack([low[a:b], high[a:b]], axis=1)


def covered(spans: np.ndarray, n: int) -> np.ndarray:
    """Which of n symbols lie in any of the spans (rows low, high)."""
    steps = np.zeros(n + 1, dtype=np.int64)
    if len(spans):
        np.add.at(steps, np.minimum(spans[:, 0], n), 1)
        np.add.at(steps, np.minimum(spans[:, 1], n), -1)
    return np.cumsum(steps[:n]) > 0
