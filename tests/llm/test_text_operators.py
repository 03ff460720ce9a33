"""Fingerprints, archives, licences, tokens, languages and leaks."""

import base64
import gzip
import hashlib
import io
import math
import random
import textwrap

import brute
import numpy as np
import pytest

from conftest import TESTDATA
from shelfmetrics.llm import bpe, decontaminate, fingerprints, language, licences, queries, warc

# Fingerprints --------------------------------------------------------------------------------


def test_likeness_estimates_jaccard(spark):
    rng = random.Random(1)
    base = [f"w{rng.randrange(5000)}" for _ in range(600)]
    docs = []
    for i, share in enumerate((0.0, 0.2, 0.5, 0.8, 1.0)):
        other = list(base)
        for k in range(int(share * 600)):
            other[k] = f"x{rng.randrange(5000)}"
        docs += [(2 * i, " ".join(base)), (2 * i + 1, " ".join(other))]
    got = {r.doc_id: r for r in fingerprints.edited_pairs(brute.frame(spark, docs)).collect()}
    for i in range(5):
        a, b = (brute.shingles(docs[2 * i + k][1], 5) for k in (0, 1))
        assert abs(got[2 * i].near_next - len(a & b) / len(a | b)) < 0.16
    assert got[0].near_next == 1.0 and got[0].fingerprint == got[1].fingerprint == got[2].fingerprint


def test_edited_texts(spark):
    docs = sorted(dict(brute.edge_docs()).items())
    df = brute.frame(spark, docs).repartition(6)
    got = {r.doc_id: r for r in fingerprints.digest(df).collect()}
    prints: dict[str, str] = {}
    for k, (i, text) in enumerate(docs):
        text, after = text or "", docs[(k + 1) % len(docs)][1] or ""
        half = len(text) // 2
        edited = text[: len(text) - half] + after[:half]
        assert (got[i].n_chars, got[i].edited_sha256) == (len(text), brute.sha(edited))
        assert 0 <= got[i].near_edited <= 1 and 0 <= got[i].near_next <= 1
        for t, f in ((text, got[i].fingerprint), (edited, got[i].edited_fingerprint)):
            assert len(f) == 2 * fingerprints.BINS
            assert prints.setdefault(t, f) == f


def test_fingerprints_of_odd_tables(spark):
    assert fingerprints.digest(brute.frame(spark, [])).count() == 0
    one = fingerprints.digest(brute.frame(spark, [(None, "a b c")])).collect()
    assert one[0].doc_id is None and one[0].near_next == 1.0
    twice = fingerprints.digest(brute.frame(spark, [(1, "a"), (1, "a"), (None, None), (None, "b")]))
    assert twice.count() == 4


# Archives ------------------------------------------------------------------------------------


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string, archive string, ordinal int")


def test_archives_round_trip(spark, tmp_path):
    rows = [
        (5, "http://a/ b\r\nX: y", "same", "x", 1), (3, None, "same", "x", 1), (9, "u", None, "x", 1),
        (8, "u", "", "x", 1), (7, "u", "é" * 50_000, "x", 1), (7, "u", "é" * 50_000, "x", 1),
        (None, "u", "same", "x", 1), (None, "u", "alone\r\n\r\nWARC/1.1", "x", 1),
    ]
    path = f"file://{tmp_path}/warc"
    got = warc.round_trip(pages(spark, rows).repartition(3), path).collect()
    assert len(got) == len(rows)
    payload = {(r["page_id"], r["payload_digest"]): r for r in got}
    for page, _, html, *_ in rows:
        data = (html or "").encode()
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        assert payload[page, digest]["payload_bytes"] == len(data)
    kinds = sorted(((r["page_id"] or 99), r["record_type"], r["refers_to"]) for r in got)
    assert [k for k in kinds if k[0] in (3, 5)] == [(3, "response", None), (5, "revisit", 3)]
    assert [k for k in kinds if k[0] in (8, 9)] == [(8, "response", None), (9, "revisit", 8)]
    assert sorted(k[1:] for k in kinds if k[0] == 7) == [("response", None), ("revisit", 7)]
    assert sorted(k[1:] for k in kinds if k[0] == 99)[1:] == [("revisit", 3)]
    # members can be read one by one, without what stands before them
    for index in tmp_path.glob("warc/*.idx"):
        data = index.with_suffix("").read_bytes()
        for line in index.read_text().splitlines():
            offset, length, _ = line.split("\t")
            assert gzip.decompress(data[int(offset) : int(offset) + int(length)]).startswith(b"WARC/1.1")
    assert not list(tmp_path.glob("warc/raw-*"))


def test_small_payloads_are_never_revisits(spark):
    rows = [(1, "u", "ab", "", 0), (2, "u", "ab", "", 0), (3, "u", "abc", "", 0), (4, "u", "abc", "", 0)]
    got = {r.page_id: r.record_type for r in warc.round_trip(pages(spark, rows), min_bytes=3).collect()}
    assert got == {1: "response", 2: "response", 3: "response", 4: "revisit"}
    assert warc.round_trip(pages(spark, [])).count() == 0


def test_normaliser_reads_members_and_refuses_torn_files():
    records = [warc.response_record("a", k, k, "u", b"p" * k * 70_000, warc.payload_digest(b"p" * k * 70_000)) for k in range(4)]
    whole = gzip.compress(b"".join(records))
    members = b"".join(map(gzip.compress, records))
    for raw in (whole, members):
        out, index = io.BytesIO(), io.BytesIO()
        assert warc.normalise(io.BytesIO(raw), out, index, 1, {2: ("a", 1, 1)}) == 4
        at = [tuple(map(int, x.split(b"\t")[:2])) for x in index.getvalue().splitlines()]
        got = [warc.read_record(out.getvalue()[a : a + n]) for a, n in at]
        assert [r["record_type"] for r in got] == ["response", "response", "revisit", "response"]
        assert [r["payload_bytes"] for r in got] == [0, 70_000, 140_000, 210_000]
    for torn in (whole[:-20], whole[: len(whole) // 2]):
        with pytest.raises(ValueError, match="ends within"):
            warc.normalise(io.BytesIO(torn), io.BytesIO(), io.BytesIO(), 1, {})


# Licences ------------------------------------------------------------------------------------


def test_licences(spark):
    corpus = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet")
    model = licences.train(corpus)
    docs = [(k, f"Some prose first.\n{notices[k % 2]}\nAnd more.") for k, (_, notices) in enumerate(sorted(licences.TEMPLATES.items()))]
    n = len(docs)
    docs += [
        (n, "This work is licensed under the terms of the Frobnication Public Licence, version 9."),
        (n + 1, "The weather was fine and nobody said a word about it."),
        (n + 2, None), (n + 3, ""), (n + 4, "RELEASED under the mit license\n" * 3),
    ]
    got = {r["row"]["doc_id"]: r for r in licences.scan(brute.frame(spark, docs), model).collect()}
    for k, family in enumerate(sorted(licences.TEMPLATES)):
        assert got[k]["families"] == [family], family
        assert got[k]["n_paragraphs"] == 3 and got[k]["n_licences"] == 1 and got[k]["score"] > licences.CERTAIN
    assert (got[n]["families"], got[n]["n_unknown"]) == ([], 1)
    for k in (n + 1, n + 2, n + 3):
        assert (got[k]["n_licences"], got[k]["n_unknown"], got[k]["score"]) == (0, 0, 0.0)
    assert (got[n + 2]["n_paragraphs"], got[n + 4]["n_licences"], got[n + 4]["families"]) == (1, 3, ["mit"])
    assert licences.scan(brute.frame(spark, []), model).count() == 0
    licences.train(brute.frame(spark, [(1, None)]))  # nothing to learn plain text from


def test_wrapped_and_other_licences_are_not_lost(spark):
    corpus = spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").select("doc_id", "text")
    model = licences.train(corpus.union(brute.frame(spark, [(-1, "All rights reserved."), (-2, "Copyright 1999 Foo Inc. All rights reserved.")]).select("doc_id", "text")), train_docs=10**6)
    docs = [(k, "Some prose first.\n\n" + textwrap.fill(notices[-1], 60) + "\n\nAnd more.") for k, (_, notices) in enumerate(sorted(licences.TEMPLATES.items()))]
    n = len(docs)
    mit = "Permission is hereby granted, free of charge, to any person obtaining a copy\nof this software and associated documentation files."
    docs += [(n, mit), (n + 1, "All rights reserved."), (n + 2, "The road was long.\nIt rained."), (n + 3, mit.replace("\n", "\n\n"))]
    got = {r["row"]["doc_id"]: r for r in licences.scan(brute.frame(spark, docs), model).collect()}
    for k, family in enumerate(sorted(licences.TEMPLATES)):
        assert (got[k]["families"], got[k]["n_licences"], got[k]["n_unknown"]) == ([family], 1, 0), (family, got[k])
    assert (got[n]["families"], got[n]["n_unknown"]) == (["mit"], 0)
    assert (got[n + 1]["n_licences"], got[n + 1]["n_unknown"]) == (0, 1)
    assert (got[n + 2]["n_licences"], got[n + 2]["n_unknown"]) == (0, 0)


# Tokens --------------------------------------------------------------------------------------


def test_tokens_are_those_of_tiktoken(spark):
    import public_tokenizers
    import tiktoken

    encoding = tiktoken.Encoding(
        "own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=bpe.load_ranks(), special_tokens={}
    )
    docs = [*brute.edge_docs(), (90, "\x1c\x1d a\x85b\xa0  x  \t\n y ½²"), (91, "é" * 3000), (92, "ab" * 9000 + " " * 700), (93, "<|endoftext|> I'll 12345 🙂‍🙂")]
    docs += [(r.doc_id + 100, r.text) for r in spark.read.parquet(f"{TESTDATA}/sf0.001/documents.parquet").collect()]
    want = {i: encoding.encode_ordinary(t or "") for i, t in docs}
    for r in bpe.encode_decode(brute.frame(spark, docs).repartition(3)).collect():
        assert np.frombuffer(r["ids"], "<u4").tolist() == want[r["row"]["doc_id"]]
        assert bytes(r["decoded"]) == (r["row"]["text"] or "").encode()
    for r in bpe.digest(brute.frame(spark, docs)).collect():
        ids = np.array(want[r.doc_id], dtype="<u4")
        assert (r.n_tokens, r.ids_sha256) == (len(ids), brute.sha(ids.tobytes()))
    assert bpe.encode_decode(brute.frame(spark, [])).count() == 0


# Languages -----------------------------------------------------------------------------------


def test_forward_sums_all_segmentations():
    names = ["a", "ab", "b", "ba", "bab"]
    pieces = language.Pieces(names)
    probs = np.zeros((pieces.n + 1, 2))
    probs[: len(names)] = [[0.1, 0.5], [0.3, 0.1], [0.2, 0.1], [0.3, 0.2], [0.1, 0.1]]
    probs[-2] = language.UNKNOWN

    def total(word, column):
        if not word:
            return 1.0
        parts = [(p, probs[names.index(p), column]) for p in names if word.startswith(p)]
        if word[0] not in names:
            parts.append((word[0], language.UNKNOWN))
        return sum(p * total(word[len(w) :], column) for w, p in parts)

    words = ["a", "ab", "baba", "babab", "azb", "ab" * 6]
    got = language.log_likelihoods(words, pieces, probs)
    for k, word in enumerate(words):
        assert got[k] == pytest.approx([math.log(total(word, c)) for c in (0, 1)])
    assert np.isfinite(language.log_likelihoods(["ab" * 5000], pieces, probs)).all()


def test_language_held_out(spark):
    docs = spark.read.parquet(f"{TESTDATA}/sf0.01/documents.parquet")
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    rows = queries.op9_language_id(spark, f"{TESTDATA}/sf0.01").collect()
    held = [r for r in rows if r.held_out]
    assert len(rows) == len(truth) and 0.25 < len(held) / len(rows) < 0.42
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) / len(held) > 0.98


def test_language_edges(spark):
    train = [(i, "the house and the garden of the king", "en") for i in range(6)]
    train += [(i + 6, "das haus und der garten des königs", "de") for i in range(6)]
    train += [(20, None, "en"), (21, "text without a language")]
    model = language.train(brute.frame(spark, train))
    docs = [(1, "The Garden"), (2, "der königs"), (3, None), (4, ""), (5, "12 ?! 34"), (None, "the king"), (7, "ߘߙ"), (7, "ߘߙ")]
    rows = [(r["row"]["doc_id"], r["lang_pred"], r["score"]) for r in language.predict(brute.frame(spark, docs), model).collect()]
    got = {i: (lang, score) for i, lang, score in rows}
    assert (got[1][0], got[2][0], got[None][0]) == ("en", "de", "en")
    assert got[3] == got[4] == got[5] == ("und", 0.0)
    assert got[7][0] == "de" and len(rows) == len(docs)  # no letter is known: a tie, first by name
    nothing = language.train(brute.frame(spark, [(1, "a"), (2, None, "en")]))
    assert {r["lang_pred"] for r in language.predict(brute.frame(spark, docs), nothing).collect()} == {"und"}
    assert language.predict(brute.frame(spark, []), model).count() == 0


# Leaks ---------------------------------------------------------------------------------------


@pytest.mark.parametrize("window,block_bytes", [(10, 4 << 20), (3, 200), (1, 500)])
def test_leaks(spark, monkeypatch, window, block_bytes):
    monkeypatch.setattr(decontaminate, "LANE", 7)
    rng = random.Random(window)
    vocabulary = ["Aa", "bb", "cC", "dé", "e1", "--", "f'f"]
    text = lambda n: " ".join(rng.choice(vocabulary) for _ in range(n))
    items = [(i, text(rng.randrange(0, 25))) for i in range(12)] + [(3, None), (5, "?!"), (None, text(14)), (2, "bb bb")]
    docs = [*dict(brute.edge_docs()).items(), *((100 + i, text(rng.randrange(0, 80)) + " " + items[i][1]) for i in range(12))]
    benchmark = spark.createDataFrame(items + items[:2], "item_id long, text string")
    df = brute.frame(spark, docs).repartition(4)
    found = decontaminate.find_leaks(df, benchmark, window=window, block_bytes=block_bytes)
    got = {}
    for r in found.withColumn("hit", decontaminate.hit_words(found["spans"])).collect():
        spans = r["spans"]
        assert spans == sorted(spans)
        hit = sum(spans[1::2]) - sum(spans[::2])
        got[r["row"]["doc_id"]] = (r["n_words"], hit, r["items"])
    assert got == brute.leaks(docs, items, window)


def test_leaks_of_empty_tables(spark):
    none = spark.createDataFrame([], "item_id long, text string")
    docs = brute.frame(spark, [(1, "a b"), (2, None)])
    rows = decontaminate.digest(docs, none).collect()
    assert {(r.n_hit, r.n_items, r.contaminated) for r in rows} == {(0, 0, False)}
    assert decontaminate.digest(brute.frame(spark, []), none).count() == 0


def test_pieces_met_again_stay_known(monkeypatch):
    monkeypatch.setattr(bpe, "CACHED_PIECES", 3)
    own = bpe.Codec(bpe.load_ranks(), bpe.split_pattern())
    learnt = []
    monkeypatch.setattr(own, "learn", lambda pieces, learn=own.learn: (learnt.extend(pieces), learn(pieces)))
    texts = [f"zqxwv {k}zzqké 雪{k} zqxwv" for k in range(8)]
    got = [next(own.texts([t])) for t in texts]
    assert learnt.count("zqxwv") == 1 and len(own.known) + len(own.older) < len(set(learnt))
    fresh = bpe.Codec(bpe.load_ranks(), bpe.split_pattern())
    assert got == list(fresh.texts(texts)) and [b.decode() for _, b in got] == texts
