"""Benchmark decontamination by Wu-Manber search over words.

Test strings are windows of ten consecutive item words, or all words of a shorter item.
They are searched by length. For each length, the pair of words in which a window ends
looks up in a table how far the search may move on before any test string can end; where
it may not move, the pair's bucket holds the strings to test, and each is compared with
the text itself.

Items are dealt into blocks of a bounded size. A block is sent to all tasks, and the
documents pass the blocks one after another; what is found is written before the next block is
read, so that neither the driver nor a task ever holds more than one. Nothing is shuffled.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm import symbols
from shelfmetrics.llm.common import Carried, written
from shelfmetrics.llm.symbols import LOWER, NOT_ALNUM, U

WINDOW = 10
#: Bytes of item texts in one block, about.
BLOCK_BYTES = 4 << 20
TABLE_BITS = 20
LANE = 512


class WuManber:
    """Test strings of m words, given as rows of word hashes."""

    def __init__(self, strings: np.ndarray, texts: list[bytes], owners: list[list[str]]):
        n, self.m = strings.shape
        self.b = min(2, self.m)
        self.strings, self.texts, self.owners = strings, texts, owners
        self.shift = np.full(1 << TABLE_BITS, self.m - self.b + 1, dtype=np.uint16)
        for last in range(self.b - 1, self.m):
            keys = self.slot(self.blocks(strings[:, last - self.b + 1 : last + 1].ravel())[:: self.b])
            np.minimum.at(self.shift, keys, np.uint16(self.m - 1 - last))
        self.suffix = self.blocks(strings[:, -self.b :].ravel())[:: self.b]
        by = np.argsort(self.suffix, kind="stable")
        self.order, self.suffix = by, self.suffix[by]

    def blocks(self, h: np.ndarray) -> np.ndarray:
        """At i, the hash of words i to i + b - 1 (the last b - 1 are of no meaning)."""
        if self.b == 1:
            return symbols.mix(h)
        return symbols.mix(h * U(31) + np.roll(h, -1))

    def slot(self, block: np.ndarray) -> np.ndarray:
        return (block >> U(64 - TABLE_BITS)).astype(np.int64)

    def search(self, h: np.ndarray, first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(start word, string) of every occurrence within one text, judged by word hashes."""
        lengths = np.diff(first)
        long = np.flatnonzero(lengths >= self.m)
        if not len(long):
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        ends = lengths[long] - self.m + 1
        lanes = -(-ends // LANE)
        lane = np.arange(lanes.sum()) - np.repeat(np.cumsum(lanes) - lanes, lanes)
        origin = np.repeat(first[long] + self.m - 1, lanes)
        at = origin + lane * LANE
        stop = np.minimum(origin + np.repeat(ends, lanes), at + LANE)
        block = self.blocks(h)
        found = []
        while len(at):
            move = self.shift[self.slot(block[at - self.b + 1])]
            found.append(at[move == 0])
            at = at + np.maximum(move, 1)
            alive = at < stop
            at, stop = at[alive], stop[alive]
        ends_at = np.concatenate(found)
        low = np.searchsorted(self.suffix, block[ends_at - self.b + 1], "left")
        high = np.searchsorted(self.suffix, block[ends_at - self.b + 1], "right")
        starts, strings = [], []
        while len(ends_at):  # the k-th string of each bucket
            left = low < high
            ends_at, low, high = ends_at[left], low[left], high[left]
            which = self.order[low]
            same = np.ones(len(which), bool)
            for k in range(self.m):
                same &= h[ends_at - self.m + 1 + k] == self.strings[which, k]
            starts.append(ends_at[same] - self.m + 1)
            strings.append(which[same])
            low = low + 1
        return np.concatenate(starts or [np.zeros(0, np.int64)]), np.concatenate(
            strings or [np.zeros(0, np.int64)]
        )


def searchers(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[WuManber]:
    """One search per length of test string. An item without an id has occurrences, too, but
    is not named among the items."""
    batch = pa.record_batch({"t": pa.array([t for _, t in items], pa.string())})
    found: dict[bytes, tuple[np.ndarray, set]] = {}
    at = 0
    for part, raw, offsets in symbols.slices(batch, "t"):
        raw = LOWER[raw]
        start, end, first = symbols.words(raw, offsets, NOT_ALNUM)
        h, data = symbols.hashes(raw, start, end), raw.tobytes()
        for k in range(part.num_rows):
            lo, hi = first[k], first[k + 1]
            m = min(window, hi - lo)
            for i in range(lo, hi - m + 1) if m else ():
                text = b" ".join(data[start[j] : end[j]] for j in range(i, i + m))
                found.setdefault(text, (h[i : i + m], set()))[1].add(items[at + k][0])
        at += part.num_rows
    by_length: dict[int, list] = {}
    for text, (h, owners) in found.items():
        by_length.setdefault(len(h), []).append((h, text, [x for x in owners if x is not None]))
    return [
        WuManber(np.stack([x[0] for x in xs]), [x[1] for x in xs], [x[2] for x in xs])
        for _, xs in sorted(by_length.items())
    ]


def _merged(spans: list[tuple[int, int]]) -> list[int]:
    out: list[int] = []
    for lo, hi in sorted(spans):
        if out and lo <= out[-1]:
            out[-1] = max(out[-1], hi)
        else:
            out += [lo, hi]
    return out


def _search(items: list, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tests = searchers(items, window)
        for batch in batches:
            for part, raw, offsets in symbols.slices(batch, "text"):
                raw = LOWER[raw]
                start, end, first = symbols.words(raw, offsets, NOT_ALNUM)
                h = symbols.hashes(raw, start, end)
                spans: dict[int, list] = {}
                named: dict[int, set] = {}
                for test in tests:
                    at, which = test.search(h, first)
                    for i, w in zip(at.tolist(), which.tolist(), strict=True):
                        text = b" ".join(raw[start[j] : end[j]].tobytes() for j in range(i, i + test.m))
                        if text == test.texts[w]:
                            k = int(np.searchsorted(first, i, "right")) - 1
                            spans.setdefault(k, []).append((i - first[k], i - first[k] + test.m))
                            named.setdefault(k, set()).update(test.owners[w])
                old_spans, old_items = part.column("spans"), part.column("items")
                new_spans, new_items = [], []
                for k in range(part.num_rows):
                    was = old_spans[k].as_py() or []
                    was = list(zip(was[::2], was[1::2], strict=True))
                    new_spans.append(_merged(was + spans.get(k, [])))
                    new_items.append(sorted({*(old_items[k].as_py() or []), *named.get(k, ())}))
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        part.column("text"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(new_spans, pa.list_(pa.int64())),
                        pa.array(new_items, pa.list_(pa.string())),
                    ],
                    ["row", "text", "n_words", "spans", "items"],
                )

    return run


def item_blocks(
    benchmark: DataFrame, item_col: str, text_col: str, block_bytes: int
) -> Iterator[list[tuple[str | None, str | None]]]:
    """The items, block by block; a block holds about block_bytes of text."""
    own = benchmark.select(F.col(item_col).cast("string").alias("item"), F.col(text_col).alias("text"))
    own = own.where(F.col("text").isNotNull()).distinct()
    total = own.agg(F.sum(F.octet_length("text") + 64)).first()[0] or 0
    n = max(1, math.ceil(total / block_bytes))
    for k in range(n):
        block = own.where(F.pmod(F.xxhash64("text", "item"), F.lit(n)) == k)
        yield [(r[0], r[1]) for r in block.collect()]


def find_leaks(
    docs: DataFrame,
    benchmark: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    window: int = WINDOW,
    block_bytes: int = BLOCK_BYTES,
    carry: list[str] | None = None,
) -> DataFrame:
    """Find the test strings of the benchmark in every text.

    Returns per row of docs: `row` (the columns in carry; all by default), n_words, spans
    (flat list of word ranges [from, to) that are hit, merged and ascending) and items (ids, as
    strings, in ascending order). A null text has no words. Items of no words test nothing.
    Repeated rows and items change nothing; empty tables give no rows or no hits.
    """
    carried = Carried(docs, text_col, carry)
    state = carried.sent(docs).select(
        "row",
        "text",
        F.lit(0).cast("long").alias("n_words"),
        F.array().cast("array<bigint>").alias("spans"),
        F.array().cast("array<string>").alias("items"),
    )
    for k, items in enumerate(item_blocks(benchmark, item_col, item_text_col, block_bytes)):
        if k:  # the block before is done with, in the driver and in the tasks
            state = written(state, "leaks-so-far")
        state = state.mapInArrow(_search(items, window), state.schema)
    return state.select(carried.whole().alias("row"), "n_words", "spans", "items")


def hit_words(spans):
    """The number of words in a flat list of ranges."""
    signed = F.transform(spans, lambda x, i: F.when(i % 2 == 1, x).otherwise(-x))
    return F.aggregate(signed, F.lit(0).cast("long"), lambda total, x: total + x)


def digest(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    found = find_leaks(docs, benchmark, carry=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_words",
        hit_words(F.col("spans")).alias("n_hit"),
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.encode(F.array_join("items", ","), "UTF-8"), 256).alias("items_sha256"),
        (F.size("spans") > 0).alias("contaminated"),
    )


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents
), b AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark
), p AS (
  SELECT DISTINCT item_id, least(10, len(ws)) AS m,
         unnest(list_transform(range(0, greatest(len(ws) - 9, 1)),
                               lambda i: list_slice(ws, i + 1, i + least(10, len(ws))))) AS win
  FROM b WHERE len(ws) > 0
), m AS (SELECT DISTINCT m FROM p),
d AS (
  SELECT doc_id, m, unnest(range(1, len(ws) - m + 2)) AS s, ws FROM w, m WHERE len(ws) >= m
), h AS (
  SELECT d.doc_id, d.s, d.m, p.item_id
  FROM d JOIN p ON p.m = d.m AND p.win = list_slice(d.ws, d.s, d.s + d.m - 1)
), c AS (
  SELECT doc_id, count(DISTINCT i) AS n_hit
  FROM (SELECT doc_id, unnest(range(s, s + m)) AS i FROM h) GROUP BY doc_id
), t AS (
  SELECT doc_id, count(*) AS n_items, string_agg(x, ',' ORDER BY x) AS names
  FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS x FROM h) GROUP BY doc_id
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_hit, 0) AS n_hit,
       coalesce(n_items, 0) AS n_items, sha256(coalesce(names, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AS contaminated
FROM w LEFT JOIN c USING (doc_id) LEFT JOIN t USING (doc_id)
"""
