"""The Merkle manifest, the nearest neighbours and the importance draw against brute force."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import brute
import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfmetrics.llm import merkle, neighbours, resampling

sha = brute.sha


# --- Merkle manifest


def leaf(row: dict, fields) -> str:
    def one(v):
        return "-" if v is None else f"{len(str(v).encode())}:{v}"

    return sha("".join(one(row[f]) for f in fields))


def tree(hashes: list[str]):
    """The root, and each leaf's siblings level by level."""
    proofs = [[] for _ in hashes]
    nodes, under = list(hashes), [[k] for k in range(len(hashes))]
    while len(nodes) > 1:
        above, over = [], []
        for at in range(0, len(nodes), 8):
            run = nodes[at : at + 8]
            for k, leaves in enumerate(under[at : at + 8]):
                for x in leaves:
                    proofs[x].append(("".join(run[:k]), "".join(run[k + 1 :])))
            above.append(sha("".join(run)))
            over.append([x for leaves in under[at : at + 8] for x in leaves])
        nodes, under = above, over
    return nodes[0], proofs


def whole_tree(rows: list[dict], fields, shown) -> list[tuple]:
    groups: dict = {}
    for r in rows:
        groups.setdefault(r["lang"], []).append((r["doc_id"], leaf(r, fields), leaf(shown(r), fields)))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in names:
        groups[g].sort(key=lambda x: (x[0] is not None, x[0] or 0, x[1], x[2]))
        trees[g] = tree([x[1] for x in groups[g]])
    root, crown = tree([trees[g][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for (doc_id, own, presented), proof in zip(groups[g], trees[g][1], strict=True):
            cur, both = presented, [*proof, *crown[k]]
            for a, b in both:
                cur = sha(a + cur + b)
            out.append((doc_id, own, trees[g][0], root, sha("".join(a + b for a, b in both)), cur, cur == root))
    return out


def lowered(row: dict) -> dict:
    hit = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 3 == 0
    return row | {"text": brute.lower(row["text"])} if hit and row["text"] is not None else row


def test_manifest_of_hard_rows(spark):
    rng = random.Random(2)
    docs = [(i, t, rng.choice([None, "", "en", "én", "zz"])) for i, t in brute.edge_docs()]
    docs += [(None, "no id", "en"), (None, None, None), (77, "Alone", "one of its kind")]
    df = brute.frame(spark, docs).repartition(4)
    rows = [r.asDict() for r in df.collect()]
    want = whole_tree(rows, merkle.FIELDS, lowered)
    got = merkle.manifest(df, presented=merkle.tampered(), digests=True).collect()
    columns = ("leaf", "subroot", "root", "proof", "folded_root", "verified")
    assert sorted(str((r.row.doc_id, *[r[c] for c in columns])) for r in got) == sorted(map(str, want))
    assert all(r.row.asDict() in rows and r.row.spans == "s" for r in got)
    assert merkle.digest(df.limit(0)).count() == 0
    assert {v for *_, v in want} == {True, False}


@pytest.mark.parametrize("n,hot", [(1, 1), (8, 8), (9, 9), (65, 60), (700, 520), (1500, 1100)])
def test_manifest_of_any_size(spark, monkeypatch, n, hot):
    monkeypatch.setattr(merkle, "LEVELS", 2)  # so that three levels of superblocks are needed
    rows = spark.range(n).select(
        F.col("id").alias("doc_id"), F.lit("s").alias("source"), F.when(F.col("id") < hot, "hot").otherwise(F.concat(F.lit("l"), F.col("id") % 40)).alias("lang"),
        F.col("id").alias("n_chars"), F.concat(F.lit("Text "), "id").alias("text"),
    )
    want = whole_tree([r.asDict() for r in rows.collect()], merkle.FIELDS, lowered)
    assert sorted(map(tuple, merkle.digest(rows).collect())) == sorted(want)


def test_proofs_verify_and_refuse(spark):
    rows = brute.frame(spark, [(i, f"text {i}", "en" if i % 3 else "de") for i in range(90)])
    done = merkle.manifest(rows).collect()
    assert all(r.verified and r.folded_root == r.root for r in done)
    for r in done:
        proof = [(x.before, x.after) for x in r.proof]
        assert merkle.fold(r.leaf, proof) == r.root != merkle.fold(sha("other"), proof)


# --- nearest neighbours


def vectors(spark, rows):
    return spark.createDataFrame(
        [(i, v, 1, 2, "x") for i, v in rows], "vec_id long, embedding array<float>, query long, rank int, list string"
    )


def exact(rows, k=20, every=20):
    usable = {}
    for i, v in rows:
        if i is None or not v or any(x is None or not math.isfinite(x) for x in v) or not any(v):
            continue
        usable[i] = min(usable.get(i, v), v)
    ids = np.array(sorted(usable))
    x = np.array([np.array(usable[i], np.float32) for i in ids], np.float64)
    out = {}
    for k_at in np.flatnonzero(ids % every == 0):
        score = neighbours.inner(np.broadcast_to(x[k_at], x.shape), x)
        by = [b for b in np.lexsort((ids, -score)) if b != k_at][:k]
        out[int(ids[k_at])] = [(int(ids[b]), float(score[b])) for b in by]
    return out


def found(df):
    out: dict = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    hits = sum(len({i for i, _ in got.get(q, ())} & {i for i, _ in best}) for q, best in want.items())
    return hits / sum(len(best) for best in want.values())


def test_neighbours_of_hard_rows(spark):
    rng = np.random.default_rng(1)
    rows = [(i, rng.standard_normal(8).astype(np.float32).tolist()) for i in range(1, 60)]
    rows += [(100 + i, rows[0][1]) for i in range(50)]  # one vector, many ids: ties
    rows += [(0, rows[0][1]), (0, rows[0][1]), (200, None), (220, []), (240, [0.0] * 8), (260, [-0.0] * 8)]
    rows += [(280, [float("nan")] * 8), (300, [float("inf"), *[1.0] * 7]), (320, [None, *[1.0] * 7]), (None, [1.0] * 8)]
    rows += [(340, [-0.0, *[1.0] * 7]), (341, [0.0, *[1.0] * 7]), (360, [1e19] * 8), (361, [-1e-30] * 8)]
    want = exact(rows)
    got = found(neighbours.search(vectors(spark, rows).repartition(3)))
    assert got == want  # so few vectors lie in lists that are all probed
    assert {q: len(v) for q, v in got.items()} == dict.fromkeys(want, 20)
    mixed = [*rows, (380, [1.0, 2.0])]
    assert 380 not in found(neighbours.search(vectors(spark, mixed)))


def test_few_vectors_and_none(spark):
    few = vectors(spark, [(0, [1.0, 2.0]), (20, [2.0, 1.0]), (3, [-1.0, 0.5])])
    assert found(neighbours.search(few)) == {0: [(20, 4.0), (3, 0.0)], 20: [(0, 4.0), (3, -1.5)]}
    assert neighbours.search(few.limit(0)).count() == 0
    assert neighbours.search(vectors(spark, [(20, [1.0])])).count() == 0
    assert neighbours.search(vectors(spark, [(20, [0.0]), (40, None)])).count() == 0


@pytest.mark.parametrize("kind", ["noise", "clusters", "lengths"])
def test_recall(spark, monkeypatch, kind):
    monkeypatch.setattr(neighbours, "BLOCK", 200)  # lists of several blocks
    monkeypatch.setattr(neighbours, "QUERIES", 30)  # and queries in several parts
    rng = np.random.default_rng(7)
    x = rng.standard_normal((6000, 48))
    if kind == "clusters":  # a third in one
        x = x * 0.2 + rng.standard_normal((40, 48))[np.where(rng.random(6000) < 0.3, 0, rng.integers(0, 40, 6000))]
    if kind == "lengths":
        x *= rng.lognormal(0, 0.5, (6000, 1))
    rows = [(i, v.astype(np.float32).tolist()) for i, v in enumerate(x)]
    want = exact(rows)
    got = found(neighbours.search(vectors(spark, rows)))
    assert recall(got, want) >= 0.95
    scores = {q: dict(best) for q, best in want.items()}
    assert all(s == scores[q][i] for q, best in got.items() for i, s in best if i in scores[q])


def test_tests_abandon_most_candidates():
    rng = np.random.default_rng(3)
    x, q = rng.standard_normal((1000, 64)), rng.standard_normal((50, 64))
    turn = neighbours.rotation(64)
    assert np.allclose(turn @ turn.T, np.eye(64))
    score = q @ x.T
    least = np.sort(score, axis=1)[:, -20]
    y = x @ turn
    columns = [y[:, at : at + 16] for at in range(0, 64, 16)]
    a, b = neighbours.survivors(q @ turn, columns, (x**2).sum(axis=1), least)
    kept = np.zeros_like(score, bool)
    kept[a, b] = True
    assert kept[score >= least[:, None]].mean() > 0.98 and kept.mean() < 0.6


# --- importance resampling


def features(text):
    ws = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", brute.lower(text or ""))
    return len(ws), ws + [f"{a} {b}" for a, b in zip(ws, ws[1:], strict=False)]


def drawn(docs, target, percent=25, least=20, buckets=10_000, seed=7):
    def counts(texts):
        return Counter(zlib.crc32(f.encode()) % buckets for t in texts for f in features(t)[1])

    s, t = counts(x for _, x in docs), counts(target)
    s_all, t_all = sum(s.values()), sum(t.values())
    gain = {
        b: math.floor(1000 * math.log((t[b] + 1) * (s_all + buckets) / ((s[b] + 1) * (t_all + buckets))))
        for b in range(buckets)
    }
    rows = []
    for i, text in docs:
        n, fs = features(text)
        weight = sum(gain[zlib.crc32(f.encode()) % buckets] for f in fs) // len(fs) if fs else 0
        score = None
        if i is not None:
            h = int(hashlib.sha256(f"{seed}:{i}".encode()).hexdigest()[:8], 16)
            score = weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))
        rows.append([i, n, len(fs), weight, score, None])
    may = sorted((r for r in rows if r[0] is not None and r[1] >= least), key=lambda r: (-r[4], r[0], r[2], r[3]))
    for k, r in enumerate(may[: len(may) * percent // 100]):
        r[5] = k + 1
    return sorted(map(str, rows))


def got_draw(df, target, **more):
    done = resampling.resample(df, target, **more).collect()
    assert all(r.row.id == 7 and r.row.spans == "s" for r in done)
    return sorted(str([r.row.doc_id, r.n_words, r.n_features, r.weight, r.score, r.rank]) for r in done)


@pytest.mark.parametrize("percent,least", [(25, 20), (60, 1), (100, 0), (0, 20)])
def test_draw(spark, percent, least):
    rng = random.Random(5)
    words = ["Alpha", "beta", "42", "été", "日本語", "x" * 60, "o", "K"]
    docs = [*brute.edge_docs(), (None, "a b c " * 30), (None, None), (900, "日本" * 4000), (901, "w " * 9000)]
    docs += [(1000 + i, " ".join(rng.choices(words, k=rng.randrange(0, 90)))) for i in range(300)]
    docs += [(5000, "the same row again " * 9)] * 200  # one key with a third of all rows
    target = ["beta 42 beta été", None, "", "Alpha alpha!o"]
    df, items = brute.frame(spark, docs).repartition(5), brute.frame(spark, list(enumerate(target)))
    got = got_draw(df, items, percent=percent, least_words=least)
    assert got == drawn(docs, target, percent, least)


def test_draw_from_little(spark, monkeypatch):
    empty = brute.frame(spark, [(1, "x")]).limit(0)
    docs = [(i, f"w{i % 3} " * 25) for i in range(50)]
    df = brute.frame(spark, docs)
    assert resampling.resample(empty, df).count() == 0
    monkeypatch.setattr(resampling, "STEP", 7)  # texts hashed in several steps
    assert got_draw(df, empty) == drawn(docs, [])
    assert resampling.digest(df.select("doc_id", "text"), df).where("rank is not null").count() == 12


def test_bracket_is_widened(spark):
    rows = spark.range(10_000).select(F.floor(F.col("id") / 4000).alias("score"))
    for rank in (1, 1999, 2000, 2001, 6000, 6001, 10_000):
        low, high, above = resampling.bracket(rows, rank, 10_000, width=0.0001)
        scores = sorted((k // 4000 for k in range(10_000)), reverse=True)
        assert low <= scores[rank - 1] <= high and above == sum(s > high for s in scores) < rank
