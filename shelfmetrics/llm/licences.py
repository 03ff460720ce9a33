"""License scan: a trained paragraph classifier whose predictions templates confirm.

A paragraph is a line. A notice wrapped over several lines between blank ones is found by the word
pairs of its joined lines, and counts once in place of these. A paragraph's features are hashed words and pairs of words; a multinomial
logistic regression over them tells licence families from other text. It is fitted on
variants of the templates below, on notices of other licences as examples of `unknown`, and on a
bounded sample of the corpus's own paragraphs, without those that speak of rights or licences.
Probabilities are calibrated by a temperature fitted on a held-out part. A paragraph that
is a licence by them, but of no family with enough certainty, or that does not hold enough
of the predicted family's template, is reported as `unknown`.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmetrics.llm import symbols
from shelfmetrics.llm.symbols import LOWER, NOT_ALNUM, U, mix

#: The customary notices of common licences.
TEMPLATES = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License.",
        "Licensed under the Apache License, Version 2.0 (the License); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
    ],
    "bsd-3-clause": [
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met.",
        "Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.",
    ],
    "cc-by-4.0": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under the Creative Commons Attribution 4.0 International License.",
    ],
    "cc-by-nc-4.0": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under the Creative Commons Attribution-NonCommercial 4.0 International License.",
    ],
    "cc-by-sa-4.0": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under the Creative Commons Attribution-ShareAlike 4.0 International License.",
    ],
    "gpl-2.0": [
        "This work is licensed under the GNU General Public License, version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License version 2.",
        "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    ],
    "gpl-3.0": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "lgpl-3.0": [
        "This work is licensed under the GNU Lesser General Public License, version 3.",
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License.",
        "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    ],
    "mit": [
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the Software), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "Licensed under the Mozilla Public License, Version 2.0.",
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/.",
    ],
}
#: What a family is called in a line `SPDX-License-Identifier: ...`.
SPDX = {
    "apache-2.0": "Apache-2.0",
    "bsd-3-clause": "BSD-3-Clause",
    "cc-by-4.0": "CC-BY-4.0",
    "cc-by-nc-4.0": "CC-BY-NC-4.0",
    "cc-by-sa-4.0": "CC-BY-SA-4.0",
    "gpl-2.0": "GPL-2.0",
    "gpl-3.0": "GPL-3.0",
    "lgpl-3.0": "LGPL-3.0",
    "mit": "MIT",
    "mpl-2.0": "MPL-2.0",
}
for _family, _name in SPDX.items():
    TEMPLATES[_family].append(f"SPDX-License-Identifier: {_name}")
#: Notices of no family above.
OTHERS = [
    "ISC License",
    "The zlib License",
    "SPDX-License-Identifier: ISC",
    "SPDX-License-Identifier: EUPL-1.2",
    "Licensed under the GNU Affero General Public License, version 3.",
    "You should have received a copy of the GNU Affero General Public License along with this program.",
    "All rights reserved.",
    "Copyright (c) 2020 by the authors. All rights reserved.",
    "No part of this publication may be reproduced without prior written permission of the publisher.",
    "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted.",
    "This is free and unencumbered software released into the public domain.",
    "Distributed under the Boost Software License, Version 1.0.",
    "Made available under the terms of the Eclipse Public License v. 2.0.",
    "You may use this file under the terms of the Artistic License 2.0.",
    "This work is licensed under the terms of a proprietary licence agreement.",
]
#: Paragraphs with such words are not taught as plain text.
RIGHTS = re.compile(r"licen[cs]|copyright|rights reserved|permission (is|to)\b|redistribut|public domain", re.I)
NONE, UNKNOWN = "none", "unknown"
FEATURE_BITS = 16
#: About so many documents are read for paragraphs that are no licences, and so many of these kept.
TRAIN_DOCS = 300
TRAIN_PARAGRAPHS = 4_000
VARIANTS = 150
ROUNDS = 120
CERTAIN = 0.7
#: The share of a template's word pairs that a paragraph must hold.
CONFIRM = 0.75


def paragraphs(raw: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(start, end, text) of every line, as byte spans without the line break."""
    breaks = np.flatnonzero(raw == 10)
    start = np.sort(np.concatenate([offsets[:-1], breaks + 1]), kind="stable")
    text = np.sort(np.concatenate([np.arange(len(offsets) - 1), np.searchsorted(offsets, breaks, "right") - 1]), kind="stable")
    end = np.empty(len(start), np.int64)
    if len(start):
        last = np.append(text[1:] != text[:-1], True)
        end[:-1] = start[1:] - 1
        end[last] = offsets[text[last] + 1]
    return start, end, text


def features(raw: np.ndarray, start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(feature, pair, paragraph) of every word, and of every pair of neighbours in a paragraph:
    feature numbers, full hashes of the pairs (0 for words), and whose they are."""
    low, high, _ = symbols.words(raw, np.array([0, len(raw)]), NOT_ALNUM)
    whose = np.searchsorted(start, low, "right") - 1
    h = symbols.hashes(raw, low, high)
    pair = mix(h[:-1] * U(3) + h[1:])
    inside = whose[:-1] == whose[1:]
    pair, pair_of = pair[inside], whose[:-1][inside]
    all_h = np.concatenate([h, pair])
    of = np.concatenate([whose, pair_of])
    order = np.argsort(of, kind="stable")
    pairs = np.concatenate([np.zeros(len(h), U), pair])
    return (all_h >> U(64 - FEATURE_BITS)).astype(np.int64)[order], pairs[order], of[order]


class Classifier:
    """weights: a row for each feature and a last one, the bias, for all paragraphs."""

    def __init__(self, weights: np.ndarray, families: list[str], temperature: float):
        self.weights, self.families, self.temperature = weights, families, temperature

    def logits(self, feature: np.ndarray, of: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(paragraph, logits) of the paragraphs that have features."""
        begin = np.flatnonzero(np.diff(of, prepend=-1))
        if not len(begin):
            return np.zeros(0, np.int64), np.zeros((0, self.weights.shape[1]))
        sums = np.add.reduceat(self.weights[feature], begin, axis=0)
        size = np.diff(np.append(begin, len(of)))
        return of[begin], sums / np.sqrt(size)[:, None] + self.weights[-1]

    def probabilities(self, logits: np.ndarray) -> np.ndarray:
        z = logits / self.temperature
        z = np.exp(z - z.max(axis=1, keepdims=True))
        return z / z.sum(axis=1, keepdims=True)


def _of_lines(lines: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    raw = LOWER[np.frombuffer("\n".join(lines).encode(), dtype=np.uint8)]
    start, end, _ = paragraphs(raw, np.array([0, len(raw)]))
    return features(raw, start, end)


def template_pairs() -> dict[str, list[set[int]]]:
    out = {}
    for family, notices in TEMPLATES.items():
        out[family] = []
        for notice in notices:
            _, pairs, _ = _of_lines([notice])
            out[family].append(set(pairs[pairs != 0].tolist()))
    return out


def _variants(notice: str, background: list[str], n: int, rng: np.random.Generator) -> list[str]:
    """The notice, with words dropped or other words around it."""
    out = [notice]
    words = notice.split()
    for _ in range(n - 1):
        kept = [w for w in words if rng.random() > 0.08] or words
        around = background[rng.integers(len(background))].split() if background else []
        cut = around[: rng.integers(0, 6)]
        out.append(" ".join((cut + kept) if rng.random() < 0.5 else (kept + cut)))
    return out


def train(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", train_docs: int = TRAIN_DOCS,
    train_paragraphs: int = TRAIN_PARAGRAPHS,
) -> Classifier:
    """Fit the classifier; the corpus gives the paragraphs that are no licences: at most
    train_paragraphs of about train_docs documents, both by hash. Lines that confirm a template or
    speak of rights are not taken for such, nor are blank ones, whatever the blanks."""
    own = docs.where(F.col(text_col).isNotNull())
    total = own.count()
    share = min(1.0, train_docs / total) if total else 1.0
    draw = F.pmod(F.xxhash64(F.lit("licence"), F.col(id_col), F.substring(text_col, 1, 64)), F.lit(1 << 30))
    lines = own.where(draw < int(share * (1 << 30)) + 1).select(F.explode(F.split(text_col, "\n")).alias("line"))
    lines = lines.where(F.length(F.trim("line")) > 0).distinct()
    some = [r[0] for r in lines.orderBy(F.xxhash64("line"), "line").limit(train_paragraphs).collect()]
    templates = template_pairs()
    background = []
    for line in some:
        if RIGHTS.search(line) or not line.split():
            continue
        _, pairs, _ = _of_lines([line])
        own_pairs = set(pairs.tolist())
        if all(len(t & own_pairs) < CONFIRM * len(t) for ts in templates.values() for t in ts):
            background.append(line)
    rng = np.random.default_rng(7)
    families = [NONE, UNKNOWN, *sorted(TEMPLATES)]
    texts = list(background)
    for line in background:  # short ones, too
        words = line.split()
        at = rng.integers(len(words))
        texts.append(" ".join(words[at : at + rng.integers(1, 6)]))
    labels = [0] * len(texts)
    for label, family in enumerate(families[1:], 1):
        for notice in OTHERS if family == UNKNOWN else TEMPLATES[family]:
            variants = _variants(notice, background, VARIANTS, rng)
            texts += variants
            labels += [label] * len(variants)
    texts = [t.replace("\n", " ") for t in texts]
    feature, _, of = _of_lines(texts)
    target = np.array(labels)
    held = rng.random(len(texts)) < 0.25
    model = Classifier(_fit(feature, of, target, ~held, len(families)), families, 1.0)
    at, logits = model.logits(feature, of)
    logits, truth = logits[held[at]], target[at][held[at]]
    grid = [0.05, 0.1, 0.2, 0.35, 0.5, 0.7, 1.0, 1.4, 2.0]

    def loss(t: float) -> float:
        model.temperature = t
        p = model.probabilities(logits)[np.arange(len(truth)), truth]
        return float(-np.log(np.maximum(p, 1e-12)).mean()) if len(truth) else t

    model.temperature = min(grid, key=loss)
    return model


def _fit(feature: np.ndarray, of: np.ndarray, target: np.ndarray, chosen: np.ndarray, classes: int) -> np.ndarray:
    """Full-batch gradient steps with per-weight step sizes, weights decaying."""
    keep = chosen[of]
    feature, of = feature[keep], of[keep]
    begin = np.flatnonzero(np.diff(of, prepend=-1))
    size = np.diff(np.append(begin, len(of)))
    row = np.repeat(np.arange(len(begin)), size)
    scale = 1 / np.sqrt(size)
    truth = np.eye(classes)[target[of[begin]]]
    order = np.argsort(feature, kind="stable")
    cuts = np.flatnonzero(np.diff(feature[order], prepend=-1))
    names, by_feature = feature[order][cuts], row[order]
    w = np.zeros(((1 << FEATURE_BITS) + 1, classes))
    names = np.append(names, 1 << FEATURE_BITS)
    seen = np.full((len(names), classes), 1e-8)
    for _ in range(ROUNDS):
        z = np.add.reduceat(w[feature], begin, axis=0) * scale[:, None] + w[-1]
        z = np.exp(z - z.max(axis=1, keepdims=True))
        error = z / z.sum(axis=1, keepdims=True) - truth
        scaled = error * scale[:, None]
        grad = np.add.reduceat(scaled[by_feature], cuts, axis=0)
        grad = np.concatenate([grad, error.sum(axis=0, keepdims=True)]) + 1e-3 * w[names]
        seen += grad**2
        w[names] -= 0.5 * grad / np.sqrt(seen)
    return w.astype(np.float32)


def _wrapped(raw: np.ndarray, start: np.ndarray, end: np.ndarray, text: np.ndarray, templates: dict[str, list[set[int]]], model: Classifier):
    """(first line, last line, family, probability) of notices that lie over several lines without a
    blank one between; family is None where templates agree but the classifier is not certain."""
    low, high, first = symbols.words(raw, np.append(start, len(raw)), NOT_ALNUM)
    if len(low) < 2:
        return
    line = np.searchsorted(start, low, "right") - 1
    h = symbols.hashes(raw, low, high)
    pair = mix(h[:-1] * U(3) + h[1:])
    # blank lines and those without a word are lines that no word has
    joined = (line[1:] - line[:-1] <= 1) & (text[line[1:]] == text[line[:-1]])
    block = np.cumsum(np.append(0, ~joined))[:-1]
    known = [(t, f) for f, ts in templates.items() for t in ts]
    names = np.array(sorted(set().union(*[t for t, _ in known])), U)
    holds = np.array([[int(n) in t for t, _ in known] for n in names])
    often = [Counter(_of_lines([notice])[1].tolist()) for notices in TEMPLATES.values() for notice in notices]
    need = CONFIRM * holds.sum(axis=0)
    at = np.minimum(np.searchsorted(names, pair), len(names) - 1)
    hit = np.flatnonzero((names[at] == pair) & joined)
    if not len(hit):
        return
    own = np.unique(np.stack([block[hit], at[hit]]), axis=1)
    begin = np.flatnonzero(np.diff(own[0], prepend=-1))
    whole = np.add.reduceat(holds[own[1]].astype(np.int64), begin, axis=0)
    spans = []
    for b, t in np.argwhere(whole >= need):
        lo, hi = np.searchsorted(block[hit], [own[0][begin[b]], own[0][begin[b]] + 1])
        mine = [int(k) for k in hit[lo:hi] if holds[at[k], t]]
        most, size = 2 * int(holds[:, t].sum()) + 20, {}
        left, past = 0, -1
        for right, k in enumerate(mine):
            if right <= past:
                continue
            size[int(at[k])] = size.get(int(at[k]), 0) + 1
            while k - mine[left] > most or size[int(at[mine[left]])] > 1:
                name = int(at[mine[left]])
                size[name] -= 1
                if not size[name]:
                    del size[name]
                left += 1
            if len(size) >= need[t]:
                # on to the notice's end, but not into another copy
                last, seen = right, Counter(int(names[at[k]]) for k in mine[left : right + 1])
                while last + 1 < len(mine) and mine[last + 1] - mine[last] <= 6:
                    seen[int(names[at[mine[last + 1]]])] += 1
                    if seen[int(names[at[mine[last + 1]]])] > often[t][int(names[at[mine[last + 1]]])]:
                        break
                    last += 1
                held = len({int(at[k]) for k in mine[left : last + 1]})
                spans.append((held / holds[:, t].sum(), held, mine[left], mine[last] + 1))
                size, left, past = {}, last + 1, last
    taken: list[tuple[int, int]] = []
    for _, _, lo, hi in sorted(spans, key=lambda x: (-x[1], -x[0], x[2])):
        if line[lo] == line[hi] or any(lo <= y and x <= hi for x, y in taken):
            continue
        taken.append((lo, hi))
        inside = pair[lo:hi]
        feature = (np.concatenate([h[lo : hi + 1], inside]) >> U(64 - FEATURE_BITS)).astype(np.int64)
        p = model.probabilities(model.logits(feature, np.zeros(len(feature), np.int64))[1])[0]
        family, sure = model.families[2 + int(p[2:].argmax())], float(p[2:].max())
        held = max(len(t & set(inside.tolist())) / len(t) for t in templates[family])
        yield int(line[lo]), int(line[hi]), family if sure >= CERTAIN and held >= CONFIRM else None, sure


def _scan(model: Classifier):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        templates = template_pairs()
        for batch in batches:
            for part, raw, offsets in symbols.slices(batch, "text"):
                raw = LOWER[raw]
                start, end, text = paragraphs(raw, offsets)
                feature, pairs, of = features(raw, start, end)
                at, logits = model.logits(feature, of)
                p = model.probabilities(logits)
                n = part.num_rows
                found: list[list[str]] = [[] for _ in range(n)]
                unknown, best = np.zeros(n, np.int64), np.zeros(n)
                lines: dict[int, tuple[str | None, float]] = {}
                for i in np.flatnonzero(p[:, 0] < 0.5):
                    family = model.families[2 + int(p[i, 2:].argmax())]
                    sure = float(p[i, 2:].max())
                    lo, hi = np.searchsorted(of, [at[i], at[i] + 1])
                    own = set(pairs[lo:hi].tolist())
                    held = max(len(t & own) / len(t) for t in templates[family])
                    lines[int(at[i])] = (family if sure >= CERTAIN and held >= CONFIRM else None, sure)
                for low, high, family, sure in _wrapped(raw, start, end, text, templates, model):
                    inside = [k for k in range(low, high + 1) if k in lines]
                    # lines that are whole notices stay; the others are parts of this one
                    counted = any(lines[k][0] == family for k in inside if family)
                    for k in inside:
                        if lines[k][0] is None:
                            del lines[k]
                    if counted:
                        continue
                    if family or not any(k in lines for k in inside):
                        free = next((k for k in range(low, high + 1) if k not in lines), None)
                        if free is not None:
                            lines[free] = (family, sure)
                for line, (family, sure) in lines.items():
                    k = int(text[line])
                    if family:
                        found[k].append(family)
                        best[k] = max(best[k], sure)
                    else:
                        unknown[k] += 1
                count = np.bincount(text, minlength=n)
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("row"),
                        pa.array(count, pa.int64()),
                        pa.array([len(f) for f in found], pa.int64()),
                        pa.array(unknown, pa.int64()),
                        pa.array([sorted(set(f)) for f in found], pa.list_(pa.string())),
                        pa.array(np.round(best, 6), pa.float64()),
                    ],
                    ["row", "n_paragraphs", "n_licences", "n_unknown", "families", "score"],
                )

    return run


def scan(docs: DataFrame, model: Classifier, text_col: str = "text", carry: list[str] | None = None) -> DataFrame:
    """Returns per row of docs: `row` (the columns in carry; all by default), n_paragraphs (lines;
    a null or empty text is one empty line), n_licences (of a confirmed family; a wrapped one counts once), n_unknown,
    families (distinct, ascending) and score (the greatest probability of a confirmed one, else
    0). Repeated rows get the same result; an empty table gives no rows."""
    row = F.struct(*[F.col(c) for c in (docs.columns if carry is None else carry)])
    own = docs.select(row.alias("row"), F.col(text_col).cast("string").alias("text"))
    count = F.lit(0).cast("long")
    schema = own.select(
        "row",
        count.alias("n_paragraphs"),
        count.alias("n_licences"),
        count.alias("n_unknown"),
        F.array().cast("array<string>").alias("families"),
        F.lit(0.0).alias("score"),
    ).schema
    return own.mapInArrow(_scan(model), schema)


def digest(docs: DataFrame) -> DataFrame:
    own = docs.select("doc_id", "text")
    found = scan(own, train(own), carry=["doc_id"])
    return found.select(
        F.col("row.doc_id").alias("doc_id"),
        "n_paragraphs",
        "n_licences",
        "n_unknown",
        F.array_join("families", ",").alias("families"),
        "score",
    )
