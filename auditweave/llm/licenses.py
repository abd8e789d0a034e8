"""Licence scans with a trained paragraph classifier.

Multinomial logistic regression over word n-grams says to which licence family a paragraph
belongs, or that it is none: the unknown class. It is trained on notices of the families,
whole, cropped and with words around them, against paragraphs of the corpus, and the least
probability that counts as a find is calibrated on paragraphs kept out of the training. A find
is confirmed where the paragraph agrees with a template of the same family in its five-word
shingles.

Features are sparse: one- and two-word sequences of the templates by their share of the paragraph's
words, and the share of words that no template has.
"""

from __future__ import annotations

import random
from itertools import chain, repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from auditweave.llm.common import pick
from auditweave.llm.decontamination import words_of

#: Notices by which works say their licence, by family.
TEMPLATES: dict[str, tuple[str, ...]] = {
    "all-rights-reserved": (
        "All rights reserved.",
        "Copyright the authors. All rights reserved.",
    ),
    "apache": (
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this "
        "file except in compliance with the License.",
        "This project is released under the Apache 2.0 license.",
        "SPDX-License-Identifier: Apache-2.0",
    ),
    "bsd": (
        "Redistribution and use in source and binary forms, with or without modification, are "
        "permitted provided that the following conditions are met:",
        "Use of this source code is governed by a BSD-style license that can be found in the "
        "LICENSE file.",
        "Released under the BSD 3-Clause License.",
        "SPDX-License-Identifier: BSD-3-Clause",
    ),
    "cc-by": (
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "Licensed under CC BY 4.0.",
        "SPDX-License-Identifier: CC-BY-4.0",
    ),
    "cc-by-nc": (
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 "
        "International License.",
        "SPDX-License-Identifier: CC-BY-NC-4.0",
    ),
    "cc-by-sa": (
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 "
        "International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License.",
    ),
    "cc0": (
        "To the extent possible under law, the author has waived all copyright and related "
        "rights to this work.",
        "Released into the public domain under CC0 1.0 Universal.",
    ),
    "gpl": (
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms "
        "of the GNU General Public License as published by the Free Software Foundation, either "
        "version 3 of the License, or (at your option) any later version.",
        "Released under the GNU General Public License, version 2.",
        "SPDX-License-Identifier: GPL-3.0-or-later",
    ),
    "lgpl": (
        "This library is licensed under the GNU Lesser General Public License, version 2.1.",
        "SPDX-License-Identifier: LGPL-2.1-or-later",
    ),
    "mit": (
        "Released under the MIT License.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this "
        "software and associated documentation files, to deal in the Software without "
        "restriction.",
        "This project is licensed under the terms of the MIT license.",
        "SPDX-License-Identifier: MIT",
    ),
    "mpl": (
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0.",
        "SPDX-License-Identifier: MPL-2.0",
    ),
}

UNKNOWN = "unknown"
#: Documents, on average, whose paragraphs stand for text without licences; a bound.
SAMPLE_DOCS = 400
SAMPLE_PARAGRAPHS = 4000
#: Trained variants of each template.
VARIANTS = 60
SHINGLE = 5
#: Share of common shingles that confirms a find.
CONFIRM = 0.8
#: Words without a template's pairs that a notice inside a line may hold, and its least words.
GAP = 6
SHORTEST = 3
#: Share of calibration paragraphs that may pass for a licence.
FALSE_FINDS = 0.001
LOAD_WORDS = 300_000


def _shingles(words: list[bytes]) -> set[tuple]:
    if len(words) <= SHINGLE:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + SHINGLE]) for i in range(len(words) - SHINGLE + 1)}


def agreement(words: list[bytes], templates: list[set[tuple]]) -> float:
    """The largest share of a template's shingles, or of the paragraph's, that both have."""
    mine = _shingles(words)
    best = 0.0
    for other in templates:
        if mine and other:
            best = max(best, len(mine & other) / min(len(mine), len(other)))
    return best


def contained(paragraph: list[bytes], templates: list[set]) -> float:
    """The largest share of a template's shingles that the paragraph holds."""
    mine: dict[int, set] = {}
    best = 0.0
    for other in templates:
        if other:
            n = len(next(iter(other)))  # a short template is one shingle of its own length
            if n not in mine:
                mine[n] = {tuple(paragraph[i : i + n]) for i in range(len(paragraph) - n + 1)}
            best = max(best, len(mine[n] & other) / len(other))
    return best


class Features:
    """Sparse rows of many paragraphs at once."""

    def __init__(self, templates: dict[str, tuple[str, ...]]):
        words = [words_of(t) for ts in templates.values() for t in ts]
        names = sorted({w for ws in words for w in ws})
        self.word = {w: i for i, w in enumerate(names)}
        pairs = {
            self.word[a] * len(names) + self.word[b] for ws in words for a, b in zip(ws, ws[1:])
        }
        self.pairs = np.array(sorted(pairs), np.int64)
        self.size = len(names) + len(self.pairs) + 1  # the last: words of no template

    def _places(self, paragraphs: list[list[bytes]]):
        """Of all words in a row: their number in the templates, their paragraph, and where
        pairs of the templates begin, with the number of the pair."""
        sizes = np.fromiter(map(len, paragraphs), np.int64, len(paragraphs))
        total = int(sizes.sum())
        flat = chain.from_iterable(paragraphs)
        place = np.fromiter(map(self.word.get, flat, repeat(-1)), np.int64, total)
        owner = np.repeat(np.arange(len(paragraphs)), sizes)
        known = np.flatnonzero(place >= 0)
        both = known[:-1][(np.diff(known) == 1)] if len(known) > 1 else known[:0]
        both = both[owner[both] == owner[both + 1]]
        codes = place[both] * len(self.word) + place[both + 1]
        at = np.minimum(np.searchsorted(self.pairs, codes), len(self.pairs) - 1)
        both, at = both[self.pairs[at] == codes], at[self.pairs[at] == codes]
        return sizes, place, owner, both, at

    def stretches(self, paragraphs: list[list[bytes]], gap: int):
        """(paragraph, first word, end) of the stretches with template pairs at most ``gap``
        words apart."""
        sizes, _, owner, both, _ = self._places(paragraphs)
        if not len(both):
            return
        new = np.append(True, (np.diff(both) > gap + 1) | (np.diff(owner[both]) > 0))
        first = both[new]
        end = np.append(both[np.flatnonzero(new)[1:] - 1], both[-1]) + 2
        begin = (np.cumsum(sizes) - sizes)[owner[first]]
        yield from zip(owner[first].tolist(), (first - begin).tolist(), (end - begin).tolist())

    def rows(self, paragraphs: list[list[bytes]]):
        """(paragraph, feature, share) of all features that are not 0."""
        sizes, place, owner, both, at = self._places(paragraphs)
        known = np.flatnonzero(place >= 0)
        unknown = np.flatnonzero(place < 0)
        rows = np.concatenate([owner[known], owner[both], owner[unknown]])
        cols = np.concatenate(
            [place[known], len(self.word) + at, np.full(len(unknown), self.size - 1)]
        )
        return rows, cols, 1.0 / np.maximum(sizes, 1)[rows]


def _probabilities(logits: np.ndarray) -> np.ndarray:
    e = np.exp(logits - logits.max(axis=1, keepdims=True))
    return e / e.sum(axis=1, keepdims=True)


def _logits(features: Features, weights: np.ndarray, bias: np.ndarray, paragraphs) -> np.ndarray:
    rows, cols, share = features.rows(paragraphs)
    out = np.tile(bias, (len(paragraphs), 1))
    for c in range(weights.shape[1]):
        out[:, c] += np.bincount(rows, share * weights[cols, c], minlength=len(paragraphs))
    return out


def _variants(templates, noise: list[bytes], rng: random.Random):
    """Paragraphs of each family: templates whole, cropped, and with strange words around."""
    for family, texts in templates.items():
        for text in texts:
            words = words_of(text)
            yield family, words
            for _ in range(VARIANTS):
                least = max(4, len(words) * 6 // 10)
                n = rng.randint(min(least, len(words)), len(words))
                at = rng.randint(0, len(words) - n)
                part = words[at : at + n]
                if noise and rng.random() < 0.4:
                    extra = [rng.choice(noise) for _ in range(rng.randint(1, max(1, n // 3)))]
                    part = part + extra if rng.random() < 0.5 else extra + part
                yield family, part


def fit(paragraphs: list[list[bytes]], templates=TEMPLATES, seed: int = 7) -> dict:
    """The classifier from ``templates`` and from ``paragraphs`` of ordinary text."""
    rng = random.Random(seed)
    features = Features(templates)
    classes = [*templates, UNKNOWN]
    known = [_shingles(words_of(t)) for ts in templates.values() for t in ts]
    plain = [p for p in paragraphs if p and agreement(p, known) < 0.2]
    kept_out, plain = plain[::4], [p for i, p in enumerate(plain) if i % 4]
    noise = [w for p in plain[:200] for w in p if w not in features.word]
    pairs = list(_variants(templates, noise, rng))
    # whatever the corpus holds, strange words and single template words are no licence
    nothing = [(UNKNOWN, [b"\xff"] * n) for n in range(1, 30)]
    nothing += [(UNKNOWN, [w, *[b"\xff"] * rng.randint(3, 9)]) for w in features.word]
    pairs += nothing + [(UNKNOWN, p) for p in plain]
    rows, cols, share = features.rows([p for _, p in pairs])
    x = np.zeros((len(pairs), features.size), np.float32)
    np.add.at(x, (rows, cols), share)
    y = np.zeros((len(pairs), len(classes)), np.float32)
    y[np.arange(len(pairs)), [classes.index(c) for c, _ in pairs]] = 1
    weight = (1.0 / np.maximum(y.sum(axis=0), 1))[y.argmax(axis=1)][:, None] / len(classes)
    weights, bias = np.zeros((features.size, len(classes))), np.zeros(len(classes))
    speed_w, speed_b = np.zeros_like(weights), np.zeros_like(bias)
    for _ in range(400):  # Nesterov-free momentum on the whole batch
        slope = (_probabilities(x @ weights + bias) - y) * weight
        speed_w = 0.9 * speed_w - 20.0 * (x.T @ slope + 1e-6 * weights)
        speed_b = 0.9 * speed_b - 2.0 * slope.sum(axis=0)
        weights, bias = weights + speed_w, bias + speed_b
    least = 0.5
    if kept_out:
        p = _probabilities(_logits(features, weights, bias, kept_out))[:, :-1].max(axis=1)
        least = max(least, float(np.quantile(p, 1 - FALSE_FINDS)))
    return {"weights": weights, "bias": bias, "least": least, "templates": templates}


def _paragraphs(text: str | None) -> list[list[bytes]]:
    """Words of every paragraph, which is a line, that has any."""
    if not text:
        return []
    return [w for w in map(words_of, text.split("\n")) if w]


def _sample(docs: DataFrame) -> list[list[bytes]]:
    """Paragraphs of a bounded sample of documents, chosen by a hash of the text."""
    rows = pick(docs, "text").where(F.col("text").isNotNull())
    size = rows.count()
    if not size:
        return []
    chance = F.pmod(F.xxhash64("text", F.lit("licences")), F.lit(1_000_000))
    some = rows.where(chance < max(1, SAMPLE_DOCS * 1_000_000 // size))
    lines = some.select(F.explode(F.split("text", "\n")).alias("line")).where("line <> ''")
    order = F.xxhash64("line")
    found = lines.distinct().orderBy(order, "line").limit(SAMPLE_PARAGRAPHS).collect()
    return [words_of(r.line) for r in found]


def scan(docs: DataFrame, templates: dict[str, tuple[str, ...]] | None = None) -> DataFrame:
    """Per row of ``docs`` (doc_id, text) the licences that its paragraphs state.

    A paragraph is a line with a word (ASCII letters in lower case, digits, characters beyond
    ASCII). One that is nothing as a whole is searched for a notice inside it: the stretches with
    word pairs of the templates are classified by themselves, and count if the family's
    template is there to ``CONFIRM``. Gives doc_id, n_paragraphs, n_found (paragraphs of a family), n_confirmed (those
    that agree with a template of it), families and confirmed (names, ordered, each once) and
    probability (the largest of a found paragraph, else null).

    Null and empty texts have no paragraphs. Repeated rows and rows without an id each give
    a row. An empty table gives an empty result.
    """
    templates = templates or TEMPLATES
    rows = pick(docs, "doc_id", "text")
    model = docs.sparkSession.sparkContext.broadcast(fit(_sample(docs), templates))

    def classify(state, paragraphs):
        """(paragraph, family, probability) of each that is in a family."""
        p = _probabilities(
            _logits(state["features"], state["weights"], state["bias"], paragraphs)
        )
        best = p.argmax(axis=1)
        chance = p[np.arange(len(p)), best]
        unknown = len(state["templates"])
        for i in np.flatnonzero((best != unknown) & (chance >= state["least"])).tolist():
            yield i, state["families"][best[i]], float(chance[i])

    def decide(state, paragraphs):
        """(paragraph, family, probability, confirmed) of each find."""
        found = set()
        for i, family, chance in classify(state, paragraphs):
            found.add(i)
            yield i, family, chance, agreement(paragraphs[i], state["shingles"][family]) >= CONFIRM
        # the others may hold a notice in a longer line
        others = [i for i in range(len(paragraphs)) if i not in found]
        places = state["features"].stretches([paragraphs[i] for i in others], GAP)
        inside = [(others[i], paragraphs[others[i]][a:b]) for i, a, b in places if b - a >= SHORTEST]
        best: dict[int, tuple[float, str]] = {}
        if inside:
            for j, family, chance in classify(state, [words for _, words in inside]):
                at, words = inside[j]
                if contained(words, state["shingles"][family]) >= CONFIRM:
                    best[at] = max(best.get(at, (0.0, "")), (chance, family))
        for at, (chance, family) in sorted(best.items()):
            yield at, family, chance, True

    def run(batches):
        state = model.value
        if "features" not in state:
            state["features"] = Features(state["templates"])
            state["families"] = list(state["templates"])
            state["shingles"] = {
                f: [_shingles(words_of(t)) for t in ts] for f, ts in state["templates"].items()
            }
        names = pa.list_(pa.string())
        for batch in batches:
            counts = np.zeros(batch.num_rows, np.int64)
            finds: dict[int, list] = {}
            held: list[list[bytes]] = []
            owner: list[int] = []
            size = 0
            for i in range(batch.num_rows + 1):
                if size > LOAD_WORDS or (i == batch.num_rows and held):
                    for at, *find in decide(state, held):
                        finds.setdefault(owner[at], []).append(find)
                    held, owner, size = [], [], 0
                if i < batch.num_rows:
                    found = _paragraphs(batch.column(1)[i].as_py())
                    counts[i] = len(found)
                    held += found
                    owner += [i] * len(found)
                    size += sum(map(len, found))
            of = [finds.get(i, []) for i in range(batch.num_rows)]
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column(0),
                    pa.array(counts),
                    pa.array([len(f) for f in of], pa.int64()),
                    pa.array([sum(x[2] for x in f) for f in of], pa.int64()),
                    pa.array([sorted({x[0] for x in f}) for f in of], names),
                    pa.array([sorted({x[0] for x in f if x[2]}) for f in of], names),
                    pa.array([max((x[1] for x in f), default=None) for f in of], pa.float64()),
                ],
                [
                    "doc_id",
                    "n_paragraphs",
                    "n_found",
                    "n_confirmed",
                    "families",
                    "confirmed",
                    "probability",
                ],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        run,
        f"doc_id {kind}, n_paragraphs bigint, n_found bigint, n_confirmed bigint, "
        "families array<string>, confirmed array<string>, probability double",
    )
