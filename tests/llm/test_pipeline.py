"""The corpus pipeline against a plain Python version of its stages."""

import brute
import numpy as np

import corpus_pipeline
from conftest import TESTDATA
from shelfmetrics.llm import bpe

SF = f"{TESTDATA}/sf0.001"


def test_pipeline(spark):
    import public_tokenizers
    import tiktoken

    names = [name for name, _ in corpus_pipeline.STAGES]
    assert names == ["language ID", "line dedup", "n-gram Jaccard join", "benchmark decontamination", "byte-level BPE"]
    rows = spark.read.parquet(f"{SF}/documents.parquet").collect()
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    docs = [(r.doc_id, r.text) for r in rows if r.text and any(c.isalpha() for c in r.text)]
    docs = [(i, kept) for i, (_, _, kept) in brute.line_dedup(docs).items()]
    of = brute.similar_components(docs, 5, 80)
    docs = [(i, t) for i, t in docs if of[i][1] == i]
    found = brute.leaks(docs, items)
    docs = [(i, t) for i, t in docs if not found[i][1]]
    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={}
    )
    got = {r.doc_id: r for r in corpus_pipeline.run(spark, SF).collect()}
    # documents of clean text are not rejected for their language
    assert set(got) == {i for i, _ in docs}
    for i, text in docs:
        ids = np.array(encoding.encode_ordinary(text), dtype="<u4")
        assert got[i].n_tokens == len(ids) and got[i].ids_sha256 == brute.sha(ids.tobytes())
        assert got[i].round_trip


def test_stages_on_hard_rows(spark):
    docs = brute.frame(spark, [*brute.edge_docs(), (None, None), (None, "the garden and the house")])
    docs = docs.select("doc_id", "text", "lang", "source", "n_chars")
    for stages in (corpus_pipeline.STAGES, corpus_pipeline.STAGES[1:]):
        kept = docs
        for name, stage in stages:
            kept = stage(spark, kept, SF)
            if name != "byte-level BPE":
                assert kept.columns == docs.columns
                kept = spark.createDataFrame(kept.collect(), docs.schema)
        kept.collect()
    ids = [r.doc_id for r in corpus_pipeline.keep_one_of_similar(spark, docs, SF).collect()]
    assert ids.count(12) == 1 and ids.count(None) == 2 and 4 in ids and 5 not in ids and 6 not in ids
    empty = docs.limit(0)
    for _, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty, SF).count() == 0


def test_clean_rows_stay(spark):
    rows = [
        (7, "the garden behind the old house was green in spring"),
        (7, "prices of copper fell again on monday after a long week"),
        (7, "prices of copper fell again on monday after a long week"),
    ]
    docs = spark.createDataFrame(
        [(i, t, None, "s", len(t)) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long"
    )
    assert corpus_pipeline.identify_language(spark, docs, SF).count() == 3
    kept = corpus_pipeline.keep_one_of_similar(spark, docs, SF).collect()
    assert sorted(r.text for r in kept) == sorted({t for _, t in rows})


def test_texts_go_to_python_once(spark, monkeypatch):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    kind, sent = type(docs), []
    plain = kind.mapInArrow

    def spied(self, *args, **more):
        sent.append(self.schema.json())
        return plain(self, *args, **more)

    monkeypatch.setattr(kind, "mapInArrow", spied)
    for name, stage in corpus_pipeline.STAGES:
        sent.clear()
        stage(spark, docs, SF)
        assert sent or name == "line dedup"
        assert [name for s in sent if s.count('"name":"text"') > 1] == []


def test_stages_send_small_batches(spark):
    key = corpus_pipeline.BATCH
    before = spark.conf.get(key)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    try:
        for stage in (corpus_pipeline.identify_language, corpus_pipeline.drop_contaminated, corpus_pipeline.tokenise):
            for given, then in (("10000", "2000"), ("300", "300")):
                spark.conf.set(key, given)
                stage(spark, docs, SF)
                assert spark.conf.get(key) == then
    finally:
        spark.conf.set(key, before)
