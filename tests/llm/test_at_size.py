"""Steps that have to stay as sharp, and scratch data as small, where tables are large."""

import brute
import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from shelfmetrics import scratch
from shelfmetrics.llm import line_dedup, ngram_join, repeats, suffix_dedup


@pytest.fixture
def tables(monkeypatch):
    """(name, columns, number of ids) of the tables that operators write."""
    seen = []

    def noted(df, name, *more):
        out = scratch.written(df, name, *more)
        seen.append((name, out.columns, out.select("id").distinct().count() if name == "signatures" else None))
        return out

    for module in (ngram_join, corpus_pipeline):
        monkeypatch.setattr(module, "written", noted)
    return seen


def own_words(rng, docs, words):
    return [(i, " ".join(f"w{x}" for x in rng.integers(0, 1 << 40, words))) for i in range(docs)]


def test_signatures_of_similar_documents_only(spark, tables, monkeypatch):
    # bitmaps that are full, as those of 32 MB are at some GB
    monkeypatch.setattr(repeats, "SLOT_BITS", 16)
    rng = np.random.default_rng(3)
    docs = own_words(rng, 4000, 80)
    near = [(10_000 + i, f"{text} tail of {i}") for i, text in docs[:20]]
    got = {r["row"]["doc_id"]: r["component_id"] for r in ngram_join.join_similar(brute.frame(spark, docs + near)).collect()}
    assert got == {i: i % 10_000 for i, _ in docs + near}
    # 40 and what bitmaps of ids let through
    assert next(ids for name, _, ids in tables if name == "signatures") < 400


def test_what_classes_can_share(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BUCKET_SHINGLES", 500)
    rng = np.random.default_rng(4)
    docs = own_words(rng, 300, 50)
    docs += [(1000 + i, text[: len(text) - k] + " end") for k, (i, text) in enumerate(docs[:40])]
    docs += [(2000, None), (2001, ""), (2002, "one word more")]
    texts = spark.createDataFrame(docs, "id long, text string").repartition(3)
    batch = pa.RecordBatch.from_pydict({"id": [i for i, _ in docs], "text": [t for _, t in docs]})
    sets = {i: s for part, found in ngram_join.shingle_sets(batch, 4) for i, s in zip(part.column("id").to_pylist(), found, strict=True)}
    classes = spark.createDataFrame([(i, len(s)) for i, s in sets.items()], "id long, n long")
    values, counts = np.unique(np.concatenate([*sets.values()]), return_counts=True)
    several = values[counts > 1]
    want = set()
    for i, s in sets.items():
        looked_at = s[s & np.uint64(1) == 0]
        m = len(s) - int((~np.isin(looked_at, several)).sum())
        if len(s) and 100 * m >= 85 * len(s):
            want.add((i, len(s), m))
    assert {tuple(r) for r in ngram_join.able(texts, classes, 4, 85).collect()} == want
    assert 20 < len(want) < 120


def test_texts_are_kept_once_between_stages(spark, tables):
    docs = [(i, f"the garden behind house {i} was green in spring\nand no line of it comes twice in all of {i}") for i in range(30)]
    docs += [(i + 100, text) for i, text in docs[:5]]
    frame = brute.frame(spark, docs).select("doc_id", "text", "lang", "source", "n_chars")
    rows = corpus_pipeline.keep_one_of_similar(spark, frame, "").collect()
    assert sorted(r.doc_id for r in rows) == list(range(30))
    assert [name for name, columns, _ in tables if "row" in columns] == ["sets"]


def test_line_runs_go_when_they_are_searched(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(scratch, "shared_dir", lambda spark: f"file://{tmp_path}")
    docs = [(i, f"a line of all documents\na line of document {i // 2} and one other") for i in range(40)]
    done = line_dedup.drop_repeated_lines(brute.frame(spark, docs))
    assert not [p.name for p in tmp_path.iterdir() if p.name.startswith(("line-batch", "line-run"))]
    assert sum(r["n_dropped"] for r in done.collect()) == 39 + 20


def test_only_repeated_phrases_are_written(spark, monkeypatch):
    rows = {}

    def noted(df, name, *more):
        out = scratch.written(df, name, *more)
        rows[name] = max(rows.get(name, 0), out.count())
        return out

    monkeypatch.setattr(repeats, "written", noted)
    monkeypatch.setattr(repeats, "BUCKET_BYTES", 20_000, raising=False)  # several buckets
    rng = np.random.default_rng(5)
    docs = own_words(rng, 400, 40)
    docs += [(1000 + i, f"{own} {docs[i // 4][1][:120]} {own}") for i, own in own_words(rng, 60, 5)]
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"]) for r in suffix_dedup.remove_repeats(brute.frame(spark, docs)).collect()}
    want = brute.byte_repeats(docs, 50)
    assert got == {i: v[:3] for i, v in want.items()}
    written = {name: n for name, n in rows.items() if name != "id-versions"}
    assert 0 < max(written.values()) < 3000  # some 10,000 phrases


def test_full_bitmaps_let_little_through(spark, monkeypatch):
    monkeypatch.setattr(repeats, "SLOT_BITS", 16)
    texts = spark.range(8000).selectExpr("id", "id * 3 as low")
    bits = repeats.bitmap(texts, repeats._place_probes, 1, 8000).value
    held, other = (repeats.place(ids, ids * 3) for ids in (np.arange(8000), np.arange(8000, 40_000)))
    assert repeats.in_all(bits, held).all() and repeats.in_all(bits, other).mean() < 0.05
    assert repeats.in_bitmap(bits, other).mean() > 0.2
