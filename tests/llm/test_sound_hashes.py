"""Words, phrases and classes that only look equal; hot patterns; stages of the pipeline."""

import random

import brute
import numpy as np
import pytest

import corpus_pipeline
from conftest import TESTDATA
from shelfmetrics import scratch
from shelfmetrics.llm import (
    decontaminate,
    fingerprints,
    language,
    licences,
    line_dedup,
    ngram_join,
    repeats,
    substring_dedup,
    suffix_dedup,
    symbols,
)


def regular_words(n: int = 1024) -> tuple[str, str]:
    """Words of a and b, and its complement, that share every polynomial hash modulo 2^64."""
    bits = [bin(k).count("1") % 2 for k in range(n)]
    return "".join("ab"[b] for b in bits), "".join("ba"[b] for b in bits)


def test_regular_words_stay_different(spark):
    a, b = regular_words()
    tail = " ".join(f"w{k}" for k in range(19))
    docs = brute.frame(spark, [(1, f"{a} {tail}"), (2, f"{b} {tail}")])
    assert [r.n_removed for r in substring_dedup.digest(docs).orderBy("doc_id").collect()] == [0, 0]
    alone = [(1, a), (2, b), (3, a)]
    rows = ngram_join.digest(brute.frame(spark, alone)).orderBy("doc_id").collect()
    assert [r.component_id for r in rows] == [1, 2, 1]
    got = {r["row"]["doc_id"]: r["n_removed"] for r in suffix_dedup.remove_repeats(brute.frame(spark, alone)).collect()}
    assert got == {i: v[1] for i, v in brute.byte_repeats(alone, 50).items()}


def test_word_hashes_go_by_all_bytes_and_the_key():
    rng = np.random.default_rng(1)
    words = [bytes(rng.integers(97, 99, n).astype(np.uint8)) for n in [*range(1, 40), 255, 256, 257, 900] for _ in range(20)]
    words += [w + b"\0" for w in words[:200]] + [b"a" * n for n in range(1, 300)]
    raw = np.frombuffer(b" ".join(words), np.uint8)
    end = np.cumsum([len(w) + 1 for w in words]) - 1
    start = end - [len(w) for w in words]
    for key in (0, symbols.new_key()):
        h = symbols.hashes(raw, start, end, key)
        assert len(set(zip(h.tolist(), words, strict=True))) == len(set(words)) == len(set(h.tolist()))
        some = rng.permutation(len(words))  # spans in any order, from any place
        assert (symbols.hashes(raw, start[some], end[some], key) == h[some]).all()
    assert not (symbols.hashes(raw, start, end, 1) == symbols.hashes(raw, start, end, 2)).any()


def test_one_pattern_repeated_in_one_document(spark):
    """Phrases that one text repeats are searched for once, and all of them get the result."""
    pattern = "The quick brown fox jumps over thirteen lazy dogs tonight, ok! "
    docs = [(1, pattern[:55]), (2, pattern * 20_000), (3, "x" + pattern * 3), (4, "other text " * 9)]
    rows = suffix_dedup.remove_repeats(brute.frame(spark, docs)).collect()
    got = {r["row"]["doc_id"]: (r["n_removed"], r["n_spans"]) for r in rows}
    assert got[1] == (0, 0) and got[4][0] == 0
    # document 2: in each repetition the bytes that document 1 has; document 3: all but its x
    assert got[2] == (55 * 20_000, 20_000)
    assert got[3] == (len(pattern) * 3, 1)


@pytest.mark.parametrize("seed,length", [(1, 50), (2, 50), (3, 13), (4, 13)])
def test_bytes_of_few_letters(spark, monkeypatch, seed, length):
    """Anchors with many contents, shared passages in other surroundings, and repeats within."""
    monkeypatch.setattr(repeats, "STEP", 900)
    rng = random.Random(seed)
    passages = ["".join(rng.choice("abcd ") for _ in range(rng.randrange(20, 160))) for _ in range(12)]
    docs = [
        (i, "".join(rng.choice([rng.choice(passages), "".join(rng.choices("ab", k=rng.randrange(30)))]) for _ in range(rng.randrange(9))))
        for i in range(60)
    ]
    rows = suffix_dedup.remove_repeats(brute.frame(spark, docs).repartition(4), length=length).collect()
    got = {r["row"]["doc_id"]: (r["n_bytes"], r["n_removed"], r["n_spans"], bytes(r["kept"])) for r in rows}
    assert got == brute.byte_repeats(docs, length)


def test_bitmaps_go_by_their_elements(spark):
    rows = spark.range(5000)
    for elements in (None, 5000, 1):
        bits = repeats.bitmap(rows, repeats.id_hashes, 1, elements)
        held = repeats.in_bitmap(bits.value, repeats.place(np.arange(5000), np.zeros(5000, np.int64)))
        assert held.all()
    assert len(repeats.bitmap(rows, repeats.id_hashes, 1, 5000).value) == 1 << 14


def test_benchmark_in_several_blocks(spark):
    rng = random.Random(2)
    words = [f"w{k}" for k in range(60)]
    items = [(k, " ".join(rng.choices(words, k=rng.randrange(1, 30)))) for k in range(40)]
    docs = [(i, " ".join(rng.choices(words, k=40)) + " " + rng.choice(items)[1]) for i in range(80)]
    found = decontaminate.find_leaks(
        brute.frame(spark, docs), brute.frame(spark, items).withColumnRenamed("doc_id", "item_id"), block_bytes=900
    )
    got = {r["row"]["doc_id"]: (r["n_words"], sum(b - a for a, b in zip(r["spans"][::2], r["spans"][1::2], strict=True)), r["items"]) for r in found.collect()}
    assert got == brute.leaks(docs, items)


@pytest.mark.parametrize("module,run", [(line_dedup, line_dedup.digest), (fingerprints, fingerprints.digest)])
def test_native_operators_use_no_python(spark, monkeypatch, module, run):
    """Neither in what is returned, nor in what is written on the way."""
    plans = []

    def text(df):
        return df._jdf.queryExecution().executedPlan().toString()

    def written(df, *args, **more):
        plans.append(text(df))
        return scratch.written(df, *args, **more)

    monkeypatch.setattr(module, "written", written, raising=False)
    docs = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    plans.append(text(run(docs)))
    for plan in plans:
        for node in ("Python", "Pandas", "InArrow", "Scan ExistingRDD"):
            assert node not in plan or node == "Scan ExistingRDD" and "head_id" in plan
    assert len(plans) > 1 or module is fingerprints


# Licences


@pytest.fixture(scope="module")
def model(spark):
    return licences.train(spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet"))


def test_licences_of_hard_rows(spark, model):
    docs = [*brute.edge_docs(), (70, "\t\n\x0b\n \r\n"), (71, "word " * 60_000), (None, "Released under the MIT License.")]
    trained = licences.train(brute.frame(spark, docs), train_docs=10**6)
    for m in (model, trained):
        rows = licences.scan(brute.frame(spark, docs), m).collect()
        assert len(rows) == len(docs) and all(r["row"]["spans"] == "s" for r in rows)
        got = {r["row"]["doc_id"]: r for r in rows}
        assert got[None]["families"] == ["mit"]
        assert (got[70]["n_paragraphs"], got[70]["n_licences"]) == (4, 0)
    assert licences.train(brute.frame(spark, docs), train_paragraphs=0).families


def test_licence_tags_and_short_names(spark, model):
    docs = list(enumerate([f"SPDX-License-Identifier: {name}" for name in licences.SPDX.values()]))
    docs += [(90, "ISC License"), (91, "SPDX-License-Identifier: ISC"), (92, "This is licensed under the GNU Affero General Public License, version 3.")]
    got = {r["row"]["doc_id"]: r for r in licences.scan(brute.frame(spark, docs), model).collect()}
    for k, family in enumerate(licences.SPDX):
        assert got[k]["families"] == [family]
    for k in (90, 91, 92):
        assert (got[k]["families"], got[k]["n_unknown"]) == ([], 1)


# Languages and the pipeline


def test_pieces_of_any_length_count():
    names = language.vocabulary()
    longest = max(names, key=len)
    assert len(longest) == 16
    pieces = language.Pieces(names)
    probs = np.full((pieces.n + 1, 1), 1e-9)
    probs[names.index(longest)], probs[-2], probs[-1] = 0.5, 1e-9, 0
    assert np.exp(language.log_likelihoods([longest], pieces, probs))[0, 0] == pytest.approx(0.5, rel=1e-6)


def test_language_stage_uses_its_language(spark):
    rows = [r for r in spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet").collect() if r.text]
    docs = [(r.doc_id, r.text, r.lang) for r in rows]
    german = next(k for k, (_, t, lang) in enumerate(docs) if lang == "de" and len(t) > 2000)
    french = next(k for k, (_, t, lang) in enumerate(docs) if lang == "fr" and len(t) > 2000)
    docs[german] = (docs[german][0], docs[german][1], "en")  # a wrong label, and none
    docs[french] = (docs[french][0], docs[french][1], None)
    docs += [(10**6, "12345 ...", "en"), (10**6 + 1, None, "en"), (10**6 + 2, "", None)]
    given = brute.frame(spark, docs).withColumnsRenamed({"spans": "_kept", "kept": "_n"})
    kept = corpus_pipeline.identify_language(spark, given, f"{TESTDATA}/sf0.01")
    assert kept.columns == given.columns
    got = {r.doc_id: r.lang for r in kept.collect()}
    assert got[docs[german][0]] == "de" and got[docs[french][0]] == "fr"
    assert set(got) == {i for i, t, _ in docs if t and any(c.isalpha() for c in t)}
    right = [got[i] == lang for i, _, lang in docs if i in got and lang]
    assert sum(right) >= 0.97 * len(right)
    some = corpus_pipeline.identify_language(spark, given, f"{TESTDATA}/sf0.01", ["de"]).collect()
    assert {r.lang for r in some} == {"de"} and 0 < len(some) < len(got)


def test_stages_keep_clashing_columns(spark):
    sf_dir = f"{TESTDATA}/sf0.001"
    text = "the garden behind the old house was green in spring"
    docs = [(1, text, "en"), (1, text, "en"), (1, "another text of the same id " * 3, "en"), (2, text, None), (3, None, None)]
    given = brute.frame(spark, docs).withColumnsRenamed({"spans": "_kept", "kept": "_n", "line": "again", "label": "n_shingles"})
    for name, stage in corpus_pipeline.STAGES[:4]:
        out = stage(spark, given, sf_dir)
        assert out.columns == given.columns, name
        assert {(r._kept, r._n, r.again, r.n_shingles) for r in out.collect()} == {("s", "k", "l", 3)}, name
    bare = given.select("doc_id", "text")
    assert corpus_pipeline.tokenise(spark, bare, sf_dir).count() == 5
