"""Merkle dataset manifest: a hash tree over all rows, and a proof for each of them.

Every row is a leaf. The leaves of a group (a language) stand in the order of their ids; runs of
FAN consecutive nodes become one node, level by level, until one is left: the group's subroot.
The subroots, in the order of the groups, likewise become the root.

Superblocks of FAN ** LEVELS consecutive leaves are the unit of work, so a group of any size is
spread over many of them.

1. Every superblock is reduced to its top. Tops are leaves of the tree above them and are reduced
   the same way, until each group has one node; the subroots' tree follows.
2. From the root down, the tops of one superblock are cogrouped with the one path that leads from
   there to the root: the outer nodes that they need, a few for each level.
3. At last leaves and outer nodes are cogrouped by superblock in applyInPandas. One call reduces
   the leaves again, joins each leaf's siblings inside with those outside to its proof, and folds
   what is presented for the row with that proof up to a root.
"""

from __future__ import annotations

import hashlib
from collections.abc import Sequence

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfmetrics.functions.positions import with_position
from shelfmetrics.llm.common import ascii_lower, discard, written

FAN = 8
#: Levels of a superblock, which has 512 leaves.
LEVELS = 3
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
TAMPER_EVERY = 3


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def encoded(value: Column) -> Column:
    """A field as the hash takes it: `-` for null, else its UTF-8 byte count, `:` and itself."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_hash(fields: Sequence[Column]) -> Column:
    return F.sha2(F.concat(*[encoded(f) for f in fields]), 256)


def height(n: int) -> int:
    """Levels above n nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def reduced(hashes: list[str], n: int) -> list[list[str]]:
    """The nodes of a superblock by level; n: the nodes of the whole tree at the lowest of them."""
    out = [hashes]
    for _ in range(min(LEVELS, height(n))):
        below = out[-1]
        out.append([sha("".join(below[at : at + FAN])) for at in range(0, len(below), FAN)])
    return out


def siblings(nodes: list[list[str]], at: int) -> list[tuple[str, str]]:
    """For each level above a leaf, the run's nodes before and after its own, joined."""
    out = []
    for level in nodes[:-1]:
        start = at - at % FAN
        out.append(("".join(level[start:at]), "".join(level[at + 1 : start + FAN])))
        at //= FAN
    return out


def fold(leaf: str, proof: list[tuple[str, str]]) -> str:
    """The root that a leaf and its siblings lead to."""
    for before, after in proof:
        leaf = sha(before + leaf + after)
    return leaf


def _path_text(path: list[tuple[str, str]]) -> str:
    return ";".join(f"{a},{b}" for a, b in path)


def _path(text: str) -> list[tuple[str, str]]:
    return [tuple(x.split(",")) for x in text.split(";")] if text else []


def _ordered(part: pd.DataFrame) -> tuple[pd.DataFrame, list[list[str]], int]:
    """A superblock's rows in order, its nodes, and the place of its first row."""
    part = part.sort_values("i", kind="stable")
    nodes = reduced(part["h"].tolist(), int(part["n"].iat[0]))
    return part, nodes, int(part["i"].iat[0])


def _top(block: int):
    def run(part: pd.DataFrame) -> pd.DataFrame:
        part, nodes, low = _ordered(part)
        top = (part["tree"].iat[0], low // block, -(-int(part["n"].iat[0]) // block), nodes[-1][0])
        return pd.DataFrame([top], columns=["tree", "i", "n", "h"])

    return run


_NODES = "tree string, i long, n long, h string"
_PATHS = "tree string, i long, path string, subroot string"


def climb(leaves: DataFrame) -> list[DataFrame]:
    """Tables of nodes (tree, i, n, h): the leaves, the tops of their superblocks, and so on up to
    one node a tree."""
    block = FAN**LEVELS
    out = [leaves]
    most = leaves.agg(F.max("n")).first()[0] or 0
    while True:
        nodes = out[-1].select("tree", "i", "n", "h", F.floor(F.col("i") / block).alias("block"))
        tops = nodes.groupBy("tree", "block").applyInPandas(_top(block), _NODES)
        out.append(written(tops, "merkle-nodes"))
        most = -(-most // block)
        if most <= 1:
            return out


def _paths(block: int):
    def run(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({"tree": [], "i": [], "path": [], "subroot": []})
        part, nodes, low = _ordered(part)
        above, subroot = outer["path"].iat[0], outer["subroot"].iat[0]
        paths = [_path_text([*siblings(nodes, k), *_path(above)]) for k in range(len(part))]
        return pd.DataFrame({"tree": part["tree"], "i": part["i"], "path": paths, "subroot": subroot})

    return run


def descend(levels: list[DataFrame], paths: DataFrame) -> DataFrame:
    """Paths (tree, i, path, subroot) of the nodes of the lowest of the levels, from those of the
    highest one."""
    block = FAN**LEVELS
    for nodes in reversed(levels[:-1]):
        nodes = nodes.select("tree", "i", "n", "h", F.floor(F.col("i") / block).alias("block"))
        both = nodes.groupBy("tree", "block").cogroup(paths.groupBy("tree", F.col("i").alias("block")))
        paths = written(both.applyInPandas(_paths(block), _PATHS), "merkle-paths")
    return paths


def _finish(root: str, digests: bool, columns: list[str]):
    def run(part: pd.DataFrame, outer: pd.DataFrame) -> pd.DataFrame:
        if part.empty:
            return pd.DataFrame({c: [] for c in columns})
        part, nodes, low = _ordered(part)
        above, subroot = _path(outer["path"].iat[0]), outer["subroot"].iat[0]
        proofs, folded = [], []
        for k, presented in enumerate(part["presented"]):
            proof = [*siblings(nodes, k), *above]
            folded.append(fold(presented, proof))
            proofs.append(
                sha("".join(a + b for a, b in proof)) if digests
                else [{"before": a, "after": b} for a, b in proof]
            )
        return pd.DataFrame({
            "row": part["row"].tolist(), "leaf": part["h"].tolist(), "subroot": subroot, "root": root,
            "proof": proofs, "folded_root": folded, "verified": [x == root for x in folded],
        }, columns=columns)

    return run


def manifest(
    docs: DataFrame, id_col: str = "doc_id", group_col: str = "lang", fields: Sequence[str] = FIELDS,
    presented: dict[str, Column] | None = None, carry: list[str] | None = None, digests: bool = False,
) -> DataFrame:
    """The hash tree over all rows of docs, and each row's proof in it.

    Returns per row of docs: `row` (the columns in carry; all by default), leaf (the hash of the
    fields), subroot, root, proof (the siblings' hashes from the leaf up to the root, each level as
    those before and after; with digests the SHA-256 of all of them joined), folded_root (what the
    row as presented and the proof lead to) and verified (whether that is the root). `presented`
    has expressions that stand for fields when rows are verified; without it rows are presented
    as they are.

    Null fields hash as `-`, an empty text as `0:`. Rows without a group are a group, the first.
    Rows without an id come first in their group; rows of equal id go by their leaf. Rows that are
    equal in all fields have leaves of their own, in any order. An empty table gives no rows.
    """
    given = [F.col(f"`{f}`") for f in fields]
    shown = [(presented or {}).get(f, F.col(f"`{f}`")) for f in fields]
    group = F.col(f"`{group_col}`").cast("string")
    leaves = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in (docs.columns if carry is None else carry)]).alias("row"),
        # never null, and in the same order
        F.coalesce(F.concat(F.lit("="), group), F.lit("-")).alias("tree"),
        F.col(f"`{id_col}`").alias("id"),
        leaf_hash(given).alias("h"),
        (leaf_hash(shown) if presented else leaf_hash(given)).alias("presented"),
    )
    hashed = written(leaves, "leaves")
    order = [F.col("id").asc_nulls_first(), F.col("h"), F.col("presented")]
    placed = with_position(hashed, order, ["tree"], "place", "n").withColumn("i", F.col("place") - 1)
    leaves = written(placed.select("row", "tree", "i", "n", "h", "presented"), "merkle-leaves")
    discard(hashed)

    levels = climb(leaves)
    subroots = with_position(levels[-1].select("tree", "h"), [F.col("tree")], (), "place", "n")
    subroots = subroots.select(F.col("tree").alias("of"), F.lit("").alias("tree"), (F.col("place") - 1).alias("i"), "n", "h")
    subroots = written(subroots, "subroots")
    crown = climb(subroots)
    last = crown[-1].first()
    root = last["h"] if last else ""
    top = crown[-1].select("tree", "i", F.lit("").alias("path"), F.col("h").alias("subroot"))
    above = descend(crown, top).select("i", "path")
    outer = subroots.join(above, "i").select(F.col("of").alias("tree"), F.lit(0).cast("long").alias("i"), "path", F.col("h").alias("subroot"))
    outer = descend(levels[1:], outer)

    proof = F.lit("") if digests else F.array(F.struct(F.lit("").alias("before"), F.lit("").alias("after")))
    text = F.lit("")
    schema = leaves.select(
        "row", text.alias("leaf"), text.alias("subroot"), text.alias("root"), proof.alias("proof"),
        text.alias("folded_root"), F.lit(True).alias("verified"),
    ).schema
    blocks = leaves.withColumn("block", F.floor(F.col("i") / FAN**LEVELS)).groupBy("tree", "block")
    both = blocks.cogroup(outer.groupBy("tree", F.col("i").alias("block")))
    return both.applyInPandas(_finish(root, digests, schema.names), schema)


def tampered() -> dict[str, Column]:
    """Text in lower case (A-Z) in each row whose id's CRC-32 3 divides."""
    hit = F.crc32(F.col("doc_id").cast("string").cast("binary")) % TAMPER_EVERY == 0
    return {"text": F.when(F.coalesce(hit, F.lit(False)), ascii_lower(F.col("text"))).otherwise(F.col("text"))}


def digest(docs: DataFrame) -> DataFrame:
    docs = docs.select(*FIELDS)
    done = manifest(docs, presented=tampered(), carry=["doc_id"], digests=True)
    return done.select(
        F.col("row.doc_id").alias("doc_id"), "leaf", "subroot", "root",
        F.col("proof").alias("proof_sha256"), "folded_root", "verified",
    )


ORACLE_SQL = r"""
WITH RECURSIVE steps(b, k, c) AS (
  SELECT unnest(range(256)), 0, unnest(range(256))
  UNION ALL
  SELECT b, k + 1, CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END FROM steps WHERE k < 8
), crc AS (SELECT list(c ORDER BY b) AS t FROM steps WHERE k = 8),
d AS (
  SELECT documents.*, xor(list_reduce(
    list_transform(range(1, len(doc_id::VARCHAR) + 1), lambda i: ascii(substr(doc_id::VARCHAR, i, 1))::BIGINT),
    lambda c, b: xor(t[(xor(c, b) & 255) + 1], c >> 8), 4294967295), 4294967295) % 3 = 0 AS hit
  FROM documents, crc
), f AS (
  SELECT doc_id, lang, text, concat(
      coalesce(strlen(doc_id::VARCHAR) || ':' || doc_id, '-'),
      coalesce(strlen(source) || ':' || source, '-'), coalesce(strlen(lang) || ':' || lang, '-'),
      coalesce(strlen(n_chars::VARCHAR) || ':' || n_chars, '-')) AS front,
    CASE WHEN hit THEN translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') ELSE text END AS shown
  FROM d
), leaf AS (
  SELECT doc_id, lang, sha256(front || coalesce(strlen(text) || ':' || text, '-')) AS h,
         sha256(front || coalesce(strlen(shown) || ':' || shown, '-')) AS presented FROM f
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, h, presented) - 1 AS i,
         count(*) OVER (PARTITION BY lang) AS n FROM leaf
), nodes(lang, level, i, n, h) AS (
  SELECT lang, 0, i, n, h FROM placed
  UNION ALL
  SELECT lang, level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM nodes WHERE n > 1 GROUP BY lang, level, i // 8, n
), sub AS (
  SELECT lang, h, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS i, count(*) OVER () AS n
  FROM nodes WHERE n = 1
), crown(level, i, n, h) AS (
  SELECT 0, i, n, h FROM sub
  UNION ALL
  SELECT level + 1, i // 8, (n + 7) // 8, sha256(string_agg(h, '' ORDER BY i))
  FROM crown WHERE n > 1 GROUP BY level, i // 8, n
), runs AS (
  SELECT lang, level, i // 8 AS run, list(h ORDER BY i) AS hs FROM nodes WHERE n > 1 GROUP BY ALL
), tops AS (
  SELECT level, i // 8 AS run, list(h ORDER BY i) AS hs FROM crown WHERE n > 1 GROUP BY ALL
), fold(doc_id, lang, i, level, pos, cur, proof) AS (
  SELECT doc_id, lang, i, 0, i, presented, '' FROM placed
  UNION ALL
  SELECT f.doc_id, f.lang, f.i, f.level + 1, f.pos // 8,
    sha256(array_to_string(hs[: f.pos % 8], '') || f.cur || array_to_string(hs[f.pos % 8 + 2 :], '')),
    f.proof || array_to_string(hs[: f.pos % 8], '') || array_to_string(hs[f.pos % 8 + 2 :], '')
  FROM fold f JOIN runs r ON r.lang IS NOT DISTINCT FROM f.lang AND r.level = f.level AND r.run = f.pos // 8
), folded AS (
  SELECT * FROM fold
  QUALIFY row_number() OVER (PARTITION BY doc_id, lang, i ORDER BY level DESC) = 1
), high(doc_id, lang, i, level, pos, cur, proof, subroot) AS (
  SELECT f.doc_id, f.lang, f.i, 0, s.i, f.cur, f.proof, s.h
  FROM folded f JOIN sub s ON s.lang IS NOT DISTINCT FROM f.lang
  UNION ALL
  SELECT f.doc_id, f.lang, f.i, f.level + 1, f.pos // 8,
    sha256(array_to_string(hs[: f.pos % 8], '') || f.cur || array_to_string(hs[f.pos % 8 + 2 :], '')),
    f.proof || array_to_string(hs[: f.pos % 8], '') || array_to_string(hs[f.pos % 8 + 2 :], ''), f.subroot
  FROM high f JOIN tops r ON r.level = f.level AND r.run = f.pos // 8
), ended AS (
  SELECT * FROM high
  QUALIFY row_number() OVER (PARTITION BY doc_id, lang, i ORDER BY level DESC) = 1
), root AS (SELECT h AS root FROM crown WHERE n = 1)
SELECT p.doc_id, p.h AS leaf, e.subroot, root.root, sha256(e.proof) AS proof_sha256,
       e.cur AS folded_root, e.cur = root.root AS verified
FROM placed p JOIN ended e ON e.doc_id IS NOT DISTINCT FROM p.doc_id
  AND e.lang IS NOT DISTINCT FROM p.lang AND e.i = p.i CROSS JOIN root
"""
