"""Substring dedup over words: a relative parse of each text against all text before it.

The reference is all text that starts earlier, in blocks dealt by the hash of anchors. It is
indexed by phrases, which the content cuts (see repeats), and knows each phrase's earliest place.
A text is parsed from left to right: a run of phrases that the index knows from earlier places is
a factor, as long as it goes on. A window that straddles the end of a factor lies in none, so the
windows at factor ends, and only they, are looked up one by one. Words in factors or in windows
found are duplicate spans.

What this is not: no text is compared with the text of a block letter by letter, which would be
quadratic. Phrases are looked up in one join and known by their hash under a key drawn for each
run, windows by two hashes under two keys.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm import symbols
from shelfmetrics.llm.common import discard, written
from shelfmetrics.llm.repeats import Documents, Repeats, covered, span_arrays
from shelfmetrics.llm.symbols import BLANK, U, mix

WINDOW = 20
GRAM = 6


def word_symbols(key: int):
    def symbolise(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        start, end, first = symbols.words(raw, offsets, BLANK)
        return symbols.hashes(raw, start, end, key), first

    return symbolise


def later(doc: Column, low: Column, first: Column) -> Column:
    return (doc > first["id"]) | ((doc == first["id"]) & (low > first["low"]))


def _boundary_windows(window: int, symbolise):
    def make(borders):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                known = None
                for found, ids, offset, (raw, offsets, low) in borders(batch):
                    phrase, start = found.windows()
                    h = symbols.stretches(found.sums, start, start + window)
                    # a second hash, over hashes of the words under another key
                    if known is not raw:
                        known, (words, _) = raw, symbolise(raw, offsets)
                    other = np.zeros(len(start), dtype=U)
                    for k in range(window):
                        other = mix(other * U(3) + words[low + start + k])
                    text = found.text[phrase]
                    columns = [h.view(np.int64), other.view(np.int64), ids[text], start + offset[text]]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(c, pa.int64()) for c in columns], ["h1", "h2", "id", "low"]
                    )

        return run

    return make


def duplicate_spans(texts: DataFrame, window: int = WINDOW) -> list[DataFrame]:
    """(id, low, high) of words in factors and in windows found at factor boundaries."""
    parse = Repeats(texts, word_symbols(symbols.new_key()), window, min(GRAM, window), within=True)
    discard(parse.met)
    second = word_symbols(symbols.new_key())
    checks = parse.last_pass(_boundary_windows(window, second), "h1 long, h2 long, id long, low long", "boundary-windows")
    firsts = checks.groupBy("h1", "h2").agg(
        F.min(F.struct("id", "low")).alias("first"), F.count(F.lit(1)).alias("n")
    )
    firsts = written(firsts.where("n > 1").select("h1", "h2", "first"), "first-windows")
    found = checks.join(firsts, ["h1", "h2"]).where(later(F.col("id"), F.col("low"), F.col("first")))
    found = written(found.select("id", "low", (F.col("low") + window).alias("high")), "repeated-windows")
    discard(checks, firsts)
    return [*parse.spans, found]


def _cut(digests: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part, raw, offsets in symbols.slices(batch, "text"):
                start, end, first = symbols.words(raw, offsets, BLANK)
                n_removed, kept = [], []
                for k, spans in enumerate(span_arrays(part.column("spans"))):
                    lo, hi = first[k], first[k + 1]
                    gone = covered(spans, hi - lo)
                    n_removed.append(int(gone.sum()))
                    a, b = start[lo:hi][~gone].tolist(), end[lo:hi][~gone].tolist()
                    kept.append(b" ".join([raw[x:y].tobytes() for x, y in zip(a, b, strict=True)]))
                if digests:
                    kept = [hashlib.sha256(x).hexdigest() for x in kept]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(np.diff(first), pa.int64()),
                        pa.array(n_removed, pa.int64()),
                        pa.array(kept, pa.string() if digests else pa.binary()).cast(pa.string()),
                    ],
                    ["row", "n_words", "n_removed", "kept"],
                )

    return run


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", window: int = WINDOW,
    carry: list[str] | None = None, digests: bool = False,
) -> DataFrame:
    """Remove every word covered by a window of `window` words that also starts earlier: in a row
    of smaller id, or earlier in the same row.

    Returns per row of docs: `row` (the columns in carry; all by default), n_words, n_removed
    and kept (words joined by single spaces; with digests the SHA-256 of that). Null or blank
    texts have no words. Rows without an id keep all their words and take none from others; so
    do rows of an id whose text differs from the one that stands for it (see Documents).
    Repeated rows all get the same result. Empty tables give no rows.
    """
    documents = Documents(docs, id_col, text_col, carry)
    own = documents.with_spans(duplicate_spans(documents.texts, window))
    count = F.lit(0).cast("long")
    schema = own.select(
        "row", count.alias("n_words"), count.alias("n_removed"), F.lit("").alias("kept")
    ).schema
    return own.mapInArrow(_cut(digests), schema)


def digest(docs: DataFrame) -> DataFrame:
    done = remove_repeats(docs.select("doc_id", "text"), carry=["doc_id"], digests=True)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "n_words", "n_removed", F.col("kept").alias("kept_sha256")
    )


ORACLE_SQL = r"""
WITH w AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), g AS (
  SELECT doc_id, unnest(range(1, len(ws) - 18)) AS s, ws FROM w WHERE len(ws) >= 20
), k AS (
  SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS win FROM g
), r AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (PARTITION BY win ORDER BY doc_id, s) AS nth FROM k
  ) WHERE nth > 1
), c AS (SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM r),
a AS (SELECT doc_id, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM w),
o AS (
  SELECT a.doc_id, count(*) FILTER (WHERE c.i IS NOT NULL) AS n_removed,
         string_agg(word, ' ' ORDER BY a.i) FILTER (WHERE c.i IS NULL) AS kept
  FROM a LEFT JOIN c ON c.doc_id = a.doc_id AND c.i = a.i GROUP BY a.doc_id
)
SELECT w.doc_id, len(w.ws)::BIGINT AS n_words, coalesce(n_removed, 0) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM w LEFT JOIN o USING (doc_id)
"""
