"""Line, substring, byte and n-gram dedup against brute force."""

import random

import brute
import pytest
from oracle_check import compare, duck

from conftest import TESTDATA
from shelfmetrics.llm import line_dedup, ngram_join, queries, repeats, substring_dedup, suffix_dedup


@pytest.fixture(scope="module")
def small():
    return f"{TESTDATA}/sf0.001", duck(f"{TESTDATA}/sf0.001")


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_matches_sql(spark, small, key):
    sf_dir, connection = small
    assert compare(queries.queries()[key](spark, sf_dir), connection, queries.oracle_sql()[key])


def unique(docs):
    return list(dict(docs).items())


@pytest.fixture(scope="module")
def edges(spark):
    docs = brute.edge_docs()
    # dealt over partitions, with a row without an id
    return docs, brute.frame(spark, [*docs, (None, docs[3][1])]).repartition(5).persist()


def by_id(rows, *names):
    got = {}
    for r in rows:
        value = tuple(r[n] for n in names)
        assert got.setdefault(r["row"]["doc_id"], value) == value  # repeated rows agree
        assert r["row"]["spans"] == "s" and r["row"]["id"] == 7  # clashing columns are intact
    return got


def test_lines(edges):
    docs, df = edges
    rows = line_dedup.drop_repeated_lines(df).collect()
    assert len(rows) == len(docs) + 1
    got = by_id(rows, "n_lines", "n_dropped", "kept_text")
    # the row without an id comes last, and its one line is held by an earlier document
    assert got.pop(None) == (1, 1, "")
    assert got == brute.line_dedup(unique(docs))


@pytest.mark.parametrize("batches,fan_in", [(1, 2), (9, 2), (7, 3)])
def test_line_runs_of_any_shape(spark, batches, fan_in):
    rng = random.Random(batches)
    lines = [f"line number {k} of all" for k in range(30)]
    docs = [(i, "\n".join(rng.choices(lines, k=6))) for i in range(80)]
    df = line_dedup.drop_repeated_lines(brute.frame(spark, docs), batches=batches, fan_in=fan_in)
    assert by_id(df.collect(), "n_lines", "n_dropped", "kept_text") == brute.line_dedup(docs)


@pytest.mark.parametrize("window", [3, 20])
def test_words(edges, monkeypatch, window):
    monkeypatch.setattr(repeats, "STEP", 300)  # long texts are cut
    docs, df = edges
    got = by_id(substring_dedup.remove_repeats(df, window=window).collect(), "n_words", "n_removed", "kept")
    alone = got.pop(None)
    assert alone[1] == 0
    assert got == brute.word_repeats(unique(docs), window)


@pytest.mark.parametrize("length,most", [(50, 4000), (12, 4000), (12, 0)])
def test_bytes(edges, monkeypatch, length, most):
    monkeypatch.setattr(repeats, "STEP", 700)
    monkeypatch.setattr(suffix_dedup, "MOST_OF_ANCHOR", most)  # 0: string by string
    docs, df = edges
    rows = suffix_dedup.remove_repeats(df, length=length).collect()
    got = by_id(rows, "n_bytes", "n_removed", "n_spans", "kept")
    assert got.pop(None)[1] == 0
    assert {i: (*v[:3], bytes(v[3])) for i, v in got.items()} == brute.byte_repeats(unique(docs), length)


def test_suffix_sort_is_a_sort():
    import numpy as np

    rng = np.random.default_rng(5)
    text = rng.integers(97, 99, 3000).astype(np.uint8)
    at, group = rng.integers(0, 2900, 700), rng.integers(0, 5, 700)
    order, begin = suffix_dedup.SuffixSort(text, 40).classes(at, group)
    keys = [(group[i], text[at[i] : at[i] + 40].tobytes()) for i in order]
    assert keys == sorted(keys)
    assert len(begin) == len(set(keys))


def near_copies(seed: int) -> list[tuple]:
    rng = random.Random(seed)
    vocabulary = [f"w{k}" for k in range(400)]
    docs, i = [], 0
    for size in (5, 9, 30, 90, 200):
        for _ in range(3):
            base = [rng.choice(vocabulary) for _ in range(size)]
            for _ in range(14):
                copy = list(base)
                for _ in range(rng.randrange(0, max(2, size // 12))):
                    copy[rng.randrange(len(copy))] = rng.choice(vocabulary)
                if rng.random() < 0.4:  # of other length, so that bands differ
                    copy = copy[: len(copy) - rng.randrange(0, size // 5 + 1)]
                docs.append((i, " ".join(copy)))
                i += 1
    rng.shuffle(docs)
    return docs


@pytest.mark.parametrize("size,percent", [(4, 85), (5, 80)])
def test_similar(spark, edges, size, percent):
    docs = near_copies(size)
    extra = [(i + 1000, t) for i, t in unique(edges[0])]
    want = brute.similar_components(docs + extra, size, percent)
    df = brute.frame(spark, [*docs, *extra, extra[3], (None, docs[0][1])]).repartition(4)
    got = by_id(ngram_join.join_similar(df, size=size, percent=percent).collect(), "n_shingles", "component_id")
    assert got.pop(None)[1] is None
    assert got == want
    assert len({c for _, c in want.values()}) < len(want) - 40


def test_ids_shared_by_different_texts(spark):
    text = " ".join(f"w{k}" for k in range(60))
    df = brute.frame(spark, [(1, text), (2, text), (3, text + " tail"), (3, "another text altogether")])
    assert len(substring_dedup.remove_repeats(df).collect()) == 4
    assert len(suffix_dedup.remove_repeats(df).collect()) == 4
    rows = ngram_join.join_similar(df).collect()
    assert {r["component_id"] for r in rows if r["row"]["doc_id"] < 3} == {1}


def test_empty_tables(spark):
    none = brute.frame(spark, [])
    assert line_dedup.drop_repeated_lines(none).count() == 0
    assert substring_dedup.remove_repeats(none).count() == 0
    assert suffix_dedup.remove_repeats(none).count() == 0
    assert ngram_join.join_similar(none).count() == 0
    blank = brute.frame(spark, [(1, None), (2, "")])
    assert [r["n_removed"] for r in substring_dedup.remove_repeats(blank).collect()] == [0, 0]
    assert [r["n_removed"] for r in suffix_dedup.remove_repeats(blank).collect()] == [0, 0]
    assert {r["component_id"] for r in ngram_join.join_similar(blank).collect()} == {1, 2}


def test_suffixes_are_merged_within_their_first_bytes(monkeypatch):
    import numpy as np

    rng = np.random.default_rng(2)
    text = rng.integers(0, 256, 4000, dtype=np.uint8)
    text[2000:2100] = text[100:200]
    own = suffix_dedup.SuffixSort(text, 40)
    at, compared = np.arange(len(text) - 40), []
    less = own.less
    monkeypatch.setattr(own, "less", lambda x, y, equal: (compared.append(len(x)), less(x, y, equal))[1])
    order, begin = own.classes(at, np.zeros(len(at), np.int64))
    found = [text[k : k + 40].tobytes() for k in order.tolist()]
    assert found == sorted(found) and len(begin) == len(set(found)) < len(found)
    assert sum(compared) < len(at)  # before, every suffix took part in a dozen merges


def test_phrases_one_by_one():
    import numpy as np

    from shelfmetrics.llm import symbols

    rng = np.random.default_rng(4)
    sizes = [0, 3, 12, 13, 90, 0, 60, 11, 0]
    first = np.concatenate([[0], np.cumsum(sizes)])
    values = symbols.mix(rng.integers(0, 4, first[-1]).astype(np.uint64) + np.uint64(9))
    sums, length, gram = symbols.prefix(values), 12, 5
    for own in (len(values), 40):
        got = repeats.Phrases(sums, first, own, length, gram)
        at = np.arange(len(values) - gram + 1)
        grams, mask = symbols.stretches(sums, at, at + gram), (1 << repeats.PLACE_BITS) - 1
        want = []
        for k in range(len(sizes)):
            for w in range(first[k], min(first[k + 1] - length + 1, own)):
                anchor = min(range(w, w + length - gram + 1), key=lambda j: (int(grams[j]) & ~mask, j))
                if want and want[-1][0] == k and want[-1][3] == anchor:
                    want[-1][2] += 1
                else:
                    want.append([k, w, 1, anchor])
        assert [list(x) for x in zip(got.text, got.low, got.count, got.low + got.reach, strict=True)] == want
        assert got.anchor.tolist() == [int(grams[x[3]]) for x in want]
