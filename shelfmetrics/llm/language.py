"""Language identification by unigram pieces, summed over all segmentations.

Each language has probabilities for the pieces of a fixed public vocabulary. The
probability of a word is the sum over all ways to cut it into pieces, found by the forward
algorithm; a text's is the product over its words. Probabilities are fitted by expectation
maximisation: forward and backward sums give each piece's expected count over all
segmentations. Texts are lower-cased, and only runs of letters count.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm.common import Carried, worker_cache, written
from shelfmetrics.llm.symbols import U, mix, slices

VOCABULARY = "piece_bpe_32k.model"
#: About so many labelled documents of each language are read for training.
TRAIN_DOCS = 400
ROUNDS = 3
SMOOTH = 0.05
#: A letter in no piece of the vocabulary has this probability in every language.
UNKNOWN = 1e-7
CACHED_WORDS = 100_000
UNDETERMINED = "und"

LETTERS = regex.compile(r"\p{L}+")


def vocabulary(path: str | None = None) -> list[str]:
    """Lower-case pieces of letters, without word marks, of a sentencepiece model."""
    import public_tokenizers
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path or public_tokenizers.path(VOCABULARY))
    pieces = {model.id_to_piece(i).lstrip("▁").lower() for i in range(model.get_piece_size())}
    return sorted(p for p in pieces if LETTERS.fullmatch(p))


class Pieces:
    """The vocabulary, looked up by hash of code points; every letter has at least an entry
    of its own, the last one, for unknown letters."""

    def __init__(self, pieces: list[str]):
        self.n = len(pieces) + 1  # the last entry: an unknown letter
        self.longest = max(map(len, pieces), default=1)
        h = np.zeros(len(pieces), dtype=U)
        for length in range(1, self.longest + 1):
            own = [i for i, p in enumerate(pieces) if len(p) == length]
            if own:
                codes = np.array([[ord(c) for c in pieces[i]] for i in own], dtype=U)
                h[own] = self.spans(codes, length)[:, 0]
        self.order = np.argsort(h)
        self.sorted = h[self.order]

    @staticmethod
    def spans(codes: np.ndarray, length: int) -> np.ndarray:
        """Hashes of codes[:, i:i + length] for every i."""
        n = codes.shape[1] - length + 1
        h = np.full((codes.shape[0], n), length, dtype=U)
        for k in range(length):
            h = h * U(0x100000001B3) + codes[:, k : k + n]
        return mix(h)

    def find(self, codes: np.ndarray, length: int) -> np.ndarray:
        """Entry of codes[:, i:i + length] for every i; n where there is none."""
        h = self.spans(codes, length)
        at = np.minimum(np.searchsorted(self.sorted, h), len(self.sorted) - 1)
        found = np.where(self.sorted[at] == h, self.order[at], self.n)
        if length == 1:
            found[found == self.n] = self.n - 1
        return found

    def tables(self, codes: np.ndarray) -> list[np.ndarray]:
        return [self.find(codes, k) for k in range(1, min(self.longest, codes.shape[1]) + 1)]


def forward(entries: list[np.ndarray], probs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Forward sums alpha[j] (word, language) up to each letter j, and the logarithms of what
    they have been scaled by so far. entries: of words of equal length, as from Pieces.tables;
    probs: (entry + 1, language), the last row zero."""
    words, n = entries[0].shape
    alpha = np.zeros((n + 1, words, probs.shape[1]))
    alpha[0] = 1
    scale = np.zeros((n + 1, words))
    # lengths of which any of these words has a piece
    lengths = [k for k, e in enumerate(entries, 1) if (e != len(probs) - 1).any()]
    for j in range(1, n + 1):
        total = alpha[j]
        for k in lengths:
            if k > j:
                break
            shift = np.exp(scale[j - k] - scale[j - 1])[:, None]
            total += alpha[j - k] * shift * probs[entries[k - 1][:, j - k]]
        most = total.max(axis=1)
        most[most == 0] = 1
        total /= most[:, None]
        scale[j] = scale[j - 1] + np.log(most)
    return alpha, scale


def by_length(words: list[str], most: int = 20_000) -> Iterator[tuple[list[int], np.ndarray]]:
    """(places, code points) of words of equal length, in groups of a bounded size."""
    groups: dict[int, list[int]] = {}
    for i, w in enumerate(words):
        groups.setdefault(len(w), []).append(i)
    for n, places in groups.items():
        step = max(1, most * 8 // n)
        for at in range(0, len(places), step):
            own = places[at : at + step]
            text = "".join([words[i] for i in own]).encode("utf-32-le", "surrogatepass")
            yield own, np.frombuffer(text, dtype=np.uint32).reshape(len(own), n).astype(U)


def log_likelihoods(words: list[str], pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """(word, language): log probability of each word."""
    out = np.empty((len(words), probs.shape[1]))
    for places, codes in by_length(words):
        alpha, scale = forward(pieces.tables(codes), probs)
        with np.errstate(divide="ignore"):
            out[places] = np.log(alpha[-1]) + scale[-1][:, None]
    return np.maximum(out, -1e6)


def expected_counts(words: list[str], weights: np.ndarray, pieces: Pieces, probs: np.ndarray) -> np.ndarray:
    """Each entry's expected count over all segmentations, for one language's probabilities."""
    counts = np.zeros(pieces.n + 1)
    for places, codes in by_length(words):
        entries = pieces.tables(codes)
        alpha, scale = forward(entries, probs)
        # backward sums are forward sums of the reversed words
        n = codes.shape[1]
        back, back_scale = forward([e[:, ::-1] for e in entries], probs)
        whole = np.log(alpha[n, :, 0]) + scale[n]
        for k, entry in enumerate(entries, 1):
            for i in range(n - k + 1):
                log = scale[i] + back_scale[n - i - k] - whole
                part = alpha[i, :, 0] * back[n - i - k, :, 0] * probs[entry[:, i], 0] * np.exp(log)
                counts += np.bincount(entry[:, i], part * weights[places], minlength=pieces.n + 1)
    return counts


class Model:
    """Piece probabilities of each language; bounded by the vocabulary and the languages."""

    def __init__(self, languages: list[str], pieces: list[str], probs: np.ndarray):
        self.languages, self.pieces, self.probs = languages, pieces, probs


def _uniform(pieces: Pieces, languages: int) -> np.ndarray:
    probs = np.full((pieces.n + 1, languages), 1.0 / pieces.n)
    probs[-2], probs[-1] = UNKNOWN, 0
    return probs


def train(
    labelled: DataFrame,
    text_col: str = "text",
    lang_col: str = "lang",
    id_col: str = "doc_id",
    docs_per_language: int = TRAIN_DOCS,
    rounds: int = ROUNDS,
    vocabulary_path: str | None = None,
) -> Model:
    """Fit piece probabilities on about docs_per_language documents of each language, chosen by
    a hash of their ids. Rows without a language or text are left out."""
    own = labelled.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
    own = own.select(
        F.col(lang_col).alias("lang"),
        F.col(text_col).alias("text"),
        F.pmod(F.xxhash64(F.lit("train"), F.col(id_col)), F.lit(1 << 30)).alias("draw"),
    )
    sizes = {r[0]: r[1] for r in own.groupBy("lang").count().collect()}
    languages, names = sorted(sizes), vocabulary(vocabulary_path)
    pieces = Pieces(names)
    probs = _uniform(pieces, len(languages))
    if not languages:
        return Model(languages, names, probs)
    chosen = F.lit(False)
    for lang, size in sizes.items():
        share = min(1.0, docs_per_language / size)
        chosen = chosen | ((F.col("lang") == lang) & (F.col("draw") < int(share * (1 << 30)) + 1))
    counts = (
        own.where(chosen)
        .select("lang", F.explode(F.regexp_extract_all(F.lower("text"), F.lit(r"(\p{L}+)"), 1)).alias("word"))
        .groupBy("lang", "word")
        .count()
    )
    counts = written(counts, "language-words")

    for _ in range(rounds):

        def expect(frames: Iterator[pd.DataFrame], probs=probs) -> Iterator[pd.DataFrame]:
            table = Pieces(names)
            for frame in frames:
                for lang, rows in frame.groupby("lang"):
                    column = languages.index(lang)
                    got = expected_counts(
                        rows["word"].tolist(),
                        rows["count"].to_numpy(float),
                        table,
                        probs[:, [column]],
                    )
                    at = np.flatnonzero(got[:-1])
                    yield pd.DataFrame({"column": column, "entry": at, "expected": got[at]})

        sums = counts.mapInPandas(expect, "column long, entry long, expected double")
        sums = sums.groupBy("column", "entry").agg(F.sum("expected").alias("expected")).toPandas()
        found = np.zeros((pieces.n + 1, len(languages)))
        found[sums["entry"], sums["column"]] = sums["expected"]
        found[:-2] += SMOOTH
        found[-2:] = 0
        # rounding keeps the model from depending on the order in which tasks add
        probs = np.round(found / np.maximum(found.sum(axis=0), 1e-300), 12)
        probs[-2], probs[-1] = UNKNOWN, 0
    return Model(languages, names, probs)


def _predict(model: Model, names: list[str]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker_cache("language")
        pieces = Pieces(model.pieces)
        known: dict[str, int] = {}
        scores = np.zeros((0, max(1, len(model.languages))))
        for batch in batches:
            for part, _, _ in slices(batch, "text"):
                texts = part.column("text").to_pylist()
                texts = [LETTERS.findall(t.lower()) if t else [] for t in texts]
                if len(known) > CACHED_WORDS:
                    known, scores = {}, scores[:0]
                new = [w for w in {w for ws in texts for w in ws} if w not in known]
                if new and model.languages:
                    scores = np.concatenate([scores, log_likelihoods(new, pieces, model.probs)])
                    known.update(zip(new, range(len(known), len(known) + len(new)), strict=True))
                langs, sure = [], []
                for ws in texts:
                    if not ws or not model.languages:
                        langs.append(UNDETERMINED)
                        sure.append(0.0)
                        continue
                    total = scores[np.fromiter(map(known.__getitem__, ws), np.int64, len(ws))].sum(axis=0)
                    best = int(total.argmax())
                    langs.append(model.languages[best])
                    sure.append(min(1.0, 1 / math.fsum(np.exp(total - total[best]))))
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(n) for n in names), pa.array(langs, pa.string()), pa.array(sure, pa.float64())],
                    [*names, "lang_pred", "score"],
                )

    return run


def predict(
    docs: DataFrame, model: Model, text_col: str = "text", carry: list[str] | None = None
) -> DataFrame:
    """Returns per row of docs: `row` (the columns in carry; all by default), lang_pred and score,
    the posterior probability of that language under equal priors.

    Texts that are null or have no letter get `und` and score 0, as do all texts if the model
    has learned no language. Equal likelihoods: the first language by name.
    """
    carried = Carried(docs, text_col, carry)
    own = carried.sent(docs)
    schema = own.select(*carried.names, F.lit("").alias("lang_pred"), F.lit(0.0).alias("score")).schema
    done = own.mapInArrow(_predict(model, carried.names), schema)
    return done.select(carried.whole().alias("row"), "lang_pred", "score")


def fold(doc_id):
    """crc32 of the id as text, modulo 3."""
    return F.crc32(doc_id.cast("string").cast("binary")) % 3


def digest(docs: DataFrame) -> DataFrame:
    """Fitted on the folds other than 1 of its own documents. Without an id: in no fold, so
    neither held out nor used for training."""
    held_out = F.coalesce(fold(F.col("doc_id")) == 1, F.lit(False))
    model = train(docs.where(fold(F.col("doc_id")) != 1))
    predicted = predict(docs.select("doc_id", "text"), model, carry=["doc_id"])
    return predicted.select(
        F.col("row.doc_id").alias("doc_id"), "lang_pred", "score"
    ).withColumn("held_out", held_out)
