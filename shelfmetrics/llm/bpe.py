"""Byte-level BPE by recursive DuckDB queries, one in-process database per task.

A text is cut into pieces by the public pattern. The distinct pieces that a task meets for
the first time go to its database as rows (piece, position, token), one token a byte at
first. A recursive query joins neighbouring tokens with the merge table and contracts each
piece's leftmost pair of least rank, round after round, until no pair of any piece merges.
Decoding joins ids with the vocabulary and aggregates their bytes in order.

The recursion keeps every round's rows, so a piece of n bytes costs n squared in the worst
case. Pieces of more than LONG bytes are contracted by the same rule in a heap instead.
"""

from __future__ import annotations

import base64
import hashlib
import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm.common import Carried, worker_cache
from shelfmetrics.llm.symbols import slices

RANKS = "byte_bpe_50k.tiktoken"
LONG = 256
#: Bytes of pieces in one query, and pieces beyond which a task begins to forget those not met again.
QUERY_BYTES = 400_000
CACHED_PIECES = 150_000

#: Rows are tokens, linked to the next token of their piece: its place j and id nid. The pairs'
#: ranks are ids; with a place below 512 they pack into one number, whose least is the pair to
#: contract: the leftmost of least rank.
CONTRACT = """
WITH RECURSIVE t(w, i, id, j, nid, live) AS (
  SELECT w, i, id, i + 1, lead(id) OVER (PARTITION BY w ORDER BY i), true FROM parts
  UNION ALL
  SELECT p.w, p.i,
         CASE WHEN p.i = b.i THEN b.merged ELSE p.id END,
         CASE WHEN p.i = b.i THEN n.j ELSE p.j END,
         CASE WHEN p.i = b.i THEN n.nid WHEN p.j = b.i THEN b.merged ELSE p.nid END,
         b.i IS NOT NULL
  FROM (SELECT * FROM t WHERE live) p
  LEFT JOIN (
    SELECT t.w, min(m.id * 512 + t.i) % 512 AS i, min(m.id * 512 + t.i) // 512 AS merged,
           arg_min(t.j, m.id * 512 + t.i) AS j
    FROM t JOIN merges m ON m.a = t.id AND m.b = t.nid WHERE t.live GROUP BY t.w
  ) b ON b.w = p.w
  LEFT JOIN (SELECT * FROM t WHERE live) n ON n.w = p.w AND n.i = b.j AND p.i = b.i
  WHERE p.i IS DISTINCT FROM b.j
)
SELECT w, list(id ORDER BY i) AS ids FROM t WHERE NOT live GROUP BY w ORDER BY w
"""

DECODE = """
SELECT w, string_agg(hex, '' ORDER BY i) AS hex
FROM coded JOIN vocabulary USING (id) GROUP BY w ORDER BY w
"""


def load_ranks(path: str | None = None) -> dict[bytes, int]:
    import public_tokenizers

    with open(path or public_tokenizers.path(RANKS), "rb") as file:
        return {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}


def split_pattern() -> str:
    """The public pattern, with white space as Unicode defines it."""
    import public_tokenizers

    return public_tokenizers.PATTERN.replace(r"[^\s\p", r"[^\p{White_Space}\p").replace(
        r"\s", r"\p{White_Space}"
    ).replace(r"\S", r"\P{White_Space}")


class Codec:
    """Encodes pieces to ids (little-endian 32-bit) and decodes them, remembering pieces."""

    def __init__(self, ranks: dict[bytes, int], pattern: str):
        import duckdb

        self.ranks, self.split = ranks, regex.compile(pattern).findall
        # ids by piece, and what they decode to where that is not the piece itself
        self.known: dict[str, bytes] = {}
        self.older: dict[str, bytes] = {}
        self.other: dict[str, bytes] = {}
        self.bytes = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.db = duckdb.connect(":memory:", config={"threads": 1, "memory_limit": "400MB"})
        self.db.execute("SET preserve_insertion_order = false")
        a, b, c = [], [], []
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    a.append(left)
                    b.append(right)
                    c.append(rank)
        vocabulary = pa.table({"id": pa.array(ranks.values(), pa.int32()), "hex": [t.hex() for t in ranks]})
        merges = pa.table([pa.array(x, pa.int32()) for x in (a, b, c)], ["a", "b", "id"])
        for name, rows in (("vocabulary", vocabulary), ("merges", merges)):
            self.db.register("given", rows)
            self.db.execute(f"CREATE TABLE {name} AS SELECT * FROM given")
            self.db.unregister("given")

    def run(self, name: str, rows: pa.Table, query: str) -> pa.Array:
        """The last column of a query over rows, which it knows by name."""
        self.db.register(name, rows)
        out = self.db.sql(query).to_arrow_table().column(-1).combine_chunks()
        self.db.unregister(name)
        return out

    def contract(self, pieces: list[bytes]) -> list[np.ndarray]:
        sizes = np.array([len(p) for p in pieces])
        rows = [np.repeat(np.arange(len(pieces)), sizes), _places(sizes)]
        rows.append(self.bytes[np.frombuffer(b"".join(pieces), dtype=np.uint8)])
        parts = pa.table([pa.array(x, pa.int32()) for x in rows], ["w", "i", "id"])
        out = self.run("parts", parts, CONTRACT)
        ids, cuts = out.values.to_numpy(), out.offsets.to_numpy()
        return [ids[a:b] for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True)]

    def contract_long(self, piece: bytes) -> list[int]:
        """The leftmost pair of least rank, by a heap over linked tokens."""
        tokens = [piece[k : k + 1] for k in range(len(piece))]
        after, before = list(range(1, len(piece) + 1)), list(range(-1, len(piece) - 1))
        heap: list[tuple[int, int, bytes]] = []

        def offer(k: int) -> None:
            n = after[k] if k >= 0 else len(tokens)
            if k >= 0 and n < len(tokens):
                rank = self.ranks.get(tokens[k] + tokens[n])
                if rank is not None:
                    heapq.heappush(heap, (rank, k, tokens[k] + tokens[n]))

        for k in range(len(piece)):
            offer(k)
        while heap:
            _, k, merged = heapq.heappop(heap)
            n = after[k]
            if not tokens[k] or n >= len(tokens) or tokens[k] + tokens[n] != merged:
                continue
            tokens[k], tokens[n] = merged, b""
            after[k] = after[n]
            if after[n] < len(tokens):
                before[after[n]] = k
            offer(k)
            offer(before[k])
        return [self.ranks[t] for t in tokens if t]

    def decode(self, coded: list[np.ndarray]) -> list[bytes]:
        sizes = np.array([len(c) for c in coded])
        rows = [np.repeat(np.arange(len(coded)), sizes), _places(sizes), np.concatenate(coded)]
        rows = pa.table([pa.array(x, pa.int32()) for x in rows], ["w", "i", "id"])
        return [bytes.fromhex(h) for h in self.run("coded", rows, DECODE).to_pylist()]

    def learn(self, pieces: list[str]) -> None:
        """Encode pieces not met before. A piece that is a token is that token at once."""
        raw = [p.encode() for p in pieces]
        coded: list[np.ndarray | None] = [None] * len(raw)
        group: list[int] = []
        size = 0

        def flush() -> None:
            for k, ids in zip(group, self.contract([raw[k] for k in group]), strict=True):
                coded[k] = ids

        for k, piece in enumerate(raw):
            if (rank := self.ranks.get(piece)) is not None:
                coded[k] = np.array([rank], np.int32)
            elif len(piece) > LONG:
                coded[k] = np.array(self.contract_long(piece), np.int32)
            else:
                group.append(k)
                size += len(piece)
                if size >= QUERY_BYTES:
                    flush()
                    group, size = [], 0
        if group:
            flush()
        for at in range(0, len(raw), 50_000):
            some = coded[at : at + 50_000]
            for piece, ids, text in zip(pieces[at : at + 50_000], some, self.decode(some), strict=True):
                self.known[piece] = ids.astype("<u4").tobytes()
                if text != piece.encode():
                    self.other[piece] = text

    def texts(self, texts: list[str | None]) -> Iterator[tuple[bytes, bytes]]:
        """(ids as little-endian unsigned 32-bit integers, bytes decoded from them) of each text."""
        cut = [self.split(t) if t else [] for t in texts]
        if len(self.known) > CACHED_PIECES:
            self.older, self.known = self.known, {}
        new = set().union(*cut).difference(self.known)
        again = new.intersection(self.older)
        self.known.update((p, self.older[p]) for p in again)
        new -= again
        if new:
            self.learn(sorted(new))
        for ps in cut:
            ids = b"".join([self.known[p] for p in ps])
            if self.other:
                yield ids, b"".join([self.other[p] if p in self.other else p.encode() for p in ps])
            else:
                yield ids, "".join(ps).encode()


def _places(sizes: np.ndarray) -> np.ndarray:
    """0 to size - 1 for each size."""
    return np.arange(sizes.sum()) - np.repeat(np.cumsum(sizes) - sizes, sizes)


def codec(ranks: dict[bytes, int], pattern: str) -> Codec:
    """This worker process's codec; it outlives a task, so later tasks know its pieces."""
    kept = worker_cache("bpe")
    key = f"{hash((pattern, *ranks.items()))}"
    if key not in kept:
        kept[key] = Codec(ranks, pattern)
    return kept[key]


def _code(ranks: dict[bytes, int], pattern: str, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part, _, _ in slices(batch, "text"):
                done = list(own.texts(part.column("text").to_pylist()))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        pa.array([a for a, _ in done], pa.binary()),
                        pa.array([b for _, b in done], pa.binary()),
                    ],
                    [*names, "ids", "decoded"],
                )

    return run


def _digest(ranks: dict[bytes, int], pattern: str, names: list[str]):
    """As _code, but with hashes in place of ids and bytes, which then need not leave the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = codec(ranks, pattern)
        for batch in batches:
            for part, _, _ in slices(batch, "text"):
                done = [
                    (len(ids) // 4, hashlib.sha256(ids).hexdigest(), hashlib.sha256(text).hexdigest())
                    for ids, text in own.texts(part.column("text").to_pylist())
                ]
                columns = list(zip(*done, strict=True))
                yield pa.RecordBatch.from_arrays(
                    [
                        *(part.column(n) for n in names),
                        pa.array(columns[0], pa.int64()),
                        pa.array(columns[1]),
                        pa.array(columns[2]),
                    ],
                    [*names, "n_tokens", "ids_sha256", "decoded_sha256"],
                )

    return run


def encode_decode(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, ranks_path: str | None = None) -> DataFrame:
    """Returns per row of docs: `row` (the columns in carry; all by default), ids (binary: token
    ids as little-endian unsigned 32-bit integers) and decoded (the bytes decoded from them).

    A null or empty text has no tokens. Repeated rows are coded alike; an empty table gives no
    rows. Special tokens in a text are ordinary text.
    """
    carried = Carried(docs, text_col, carry)
    own = carried.sent(docs)
    binary = F.lit(b"")
    schema = own.select(*carried.names, binary.alias("ids"), binary.alias("decoded")).schema
    coded = own.mapInArrow(_code(load_ranks(ranks_path), split_pattern(), carried.names), schema)
    return coded.select(carried.whole().alias("row"), "ids", "decoded")


def token_digests(docs: DataFrame, text_col: str = "text", carry: list[str] | None = None, ranks_path: str | None = None) -> DataFrame:
    """As encode_decode, with n_tokens, ids_sha256 and decoded_sha256 in place of the bytes."""
    carried = Carried(docs, text_col, carry)
    own = carried.sent(docs)
    hashes = [F.lit("").alias("ids_sha256"), F.lit("").alias("decoded_sha256")]
    schema = own.select(*carried.names, F.lit(0).cast("long").alias("n_tokens"), *hashes).schema
    coded = own.mapInArrow(_digest(load_ranks(ranks_path), split_pattern(), carried.names), schema)
    return coded.select(carried.whole().alias("row"), "n_tokens", "ids_sha256", "decoded_sha256")


def digest(docs: DataFrame) -> DataFrame:
    coded = token_digests(docs.select("doc_id", "text"), carry=["doc_id"])
    return coded.select(F.col("row.doc_id").alias("doc_id"), "n_tokens", "ids_sha256", "decoded_sha256")
