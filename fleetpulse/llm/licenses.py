"""Licence scan: a paragraph classifier over word n-grams names the family, and a comparison with templates confirms it.

A text is read in units: its lines, longer ones in windows of `WINDOW` words that overlap by half, and such windows over
whole paragraphs (lines up to one without words) where they cross a line break. A unit has the line number of its first
word; a notice may be in several. Words are in lower case without ASCII punctuation. For each family a sparse logistic regression (single words and pairs, weights shrunk to
zero by l1) is trained on notices of that family, cut, thinned and embedded at random, against the notices of the others,
sentences about licences in another sense, shuffled notices, and lines of a bounded sample of documents. The best
family's score is calibrated on examples that the fit left out. A unit below `MIN_PROBABILITY` for each family that
reaches it for any licence at all, by a score and a calibration of its own, has a finding of family "unknown", never
confirmed, unless a named one overlaps it; other units have none.
What a family's template accounts for is then set aside and the rest of the unit is read again, so that a unit has a
finding for each family with a notice in it. A finding is confirmed if the unit has enough of one template's word pairs,
or a stretch that is mostly such pairs.

A unit that has too little weight in its words for any family or licence cannot be predicted; this bound is taken over all units in
arrays, and only the others are scored one by one. No unit is left out.

Null or empty text: no units, no licence. Null doc_id: passed on. Repeated rows: each is scanned. Very long texts are read
to the end. Ties: of equal scores the earlier family and part, of equal findings the first confirmed one. A word or pair
counts once in a unit, however often it is repeated there. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import random
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import hash_sample, ship_package, slices
from fleetpulse.llm.linear import fit_logistic, fit_platt, sigmoid
from fleetpulse.llm.text import FOLD, Batch

WINDOW = 32
PART = 12
MIN_PROBABILITY = 0.5
#: The family of a unit that reads as a licence, but as none with a template.
UNKNOWN = "unknown"
MIN_SIMILARITY = 0.6
#: Word pairs of a template that a stretch must have at least, if the template has as many.
MIN_PAIRS = 5
#: Documents whose lines serve as background, at most, and lines of them.
BACKGROUND_ROWS = 300
BACKGROUND_LINES = 3000
_SEED = 11

# Notices by family, in the words that licensors prescribe.
TEMPLATES: dict[str, list[str]] = {
    "apache-2.0": [
        "Licensed under the Apache License, Version 2.0.",
        "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0",
        "Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.",
        "SPDX-License-Identifier: Apache-2.0",
    ],
    "mit": [
        "Released under the MIT License.",
        "Licensed under the MIT License. See LICENSE in the project root for license information.",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software",
        "SPDX-License-Identifier: MIT",
    ],
    "gpl": [
        "This work is licensed under the GNU General Public License, version 3.",
        "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
        "You should have received a copy of the GNU General Public License along with this program. If not, see https://www.gnu.org/licenses/",
        "Licensed under the GNU GPL version 2 or later. SPDX-License-Identifier: GPL-2.0-or-later",
    ],
    "lgpl": [
        "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version.",
        "Licensed under the GNU Lesser General Public License, version 3. SPDX-License-Identifier: LGPL-3.0-only",
    ],
    "agpl": [
        "This program is licensed under the GNU Affero General Public License, version 3.",
        "You should have received a copy of the GNU Affero General Public License along with this program. SPDX-License-Identifier: AGPL-3.0-only",
    ],
    "bsd": [
        "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
        "Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.",
        "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file.",
        "Released under the BSD 3-Clause License. SPDX-License-Identifier: BSD-3-Clause",
    ],
    "mpl-2.0": [
        "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at http://mozilla.org/MPL/2.0/.",
        "Licensed under the Mozilla Public License, version 2.0. SPDX-License-Identifier: MPL-2.0",
    ],
    "isc": [
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.",
        "Released under the ISC License. SPDX-License-Identifier: ISC",
    ],
    "cc-by": [
        "Licensed under CC BY 4.0.",
        "This work is licensed under a Creative Commons Attribution 4.0 International License.",
        "To view a copy of this license, visit http://creativecommons.org/licenses/by/4.0/",
    ],
    "cc-by-sa": [
        "Licensed under CC BY-SA 4.0.",
        "This work is licensed under a Creative Commons Attribution-ShareAlike 4.0 International License.",
        "Text is available under the Creative Commons Attribution-ShareAlike License; additional terms may apply.",
    ],
    "cc-by-nc": [
        "Licensed under CC BY-NC 4.0.",
        "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License.",
        "Licensed under CC BY-NC-SA 4.0. Creative Commons Attribution-NonCommercial-ShareAlike 4.0 International License.",
    ],
    "cc-by-nd": [
        "Licensed under CC BY-ND 4.0.",
        "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
    ],
    "public-domain": [
        "This is free and unencumbered software released into the public domain.",
        "To the extent possible under law, the author has waived all copyright and related or neighboring rights to this work. CC0 1.0 Universal",
        "Anyone is free to copy, modify, publish, use, compile, sell, or distribute this software, either in source code form or as a compiled binary, for any purpose, commercial or non-commercial, and by any means.",
    ],
    "all-rights-reserved": [
        "All rights reserved.",
        "Copyright (c) 2020 The Authors. All rights reserved.",
        "No part of this publication may be reproduced, distributed, or transmitted in any form or by any means without the prior written permission of the publisher.",
    ],
}
# The words in another sense.
OTHER_SENSES = [
    "She renewed her driver's license at the office in version two of the form.",
    "The city council revoked the restaurant's liquor license last week.",
    "A poet may take some artistic license with the facts.",
    "The general public was free to use the park without a fee.",
    "You should have received a copy of the letter along with this parcel.",
    "The commons is a creative space for the students, with attribution to nobody.",
    "Permission to land was granted by the tower at noon.",
    "The right to work and the rights of the person are reserved to the people.",
    "The software was released on Friday and the source was open to anyone.",
    "He studied at MIT and worked for the foundation under the terms of a grant.",
    "The Apache helicopter is version two of the design.",
    "This work is under way and the public library is open.",
    "Copyright law is taught in the second year of the course.",
    "Any person obtaining a fishing license may use the lake.",
    "The lesser of the two evils is to modify the form.",
    "All reserved seats are distributed at the door.",
]
RESULT = (
    "doc_id long, family string, probability double, similarity double, confirmed boolean, "
    "findings array<struct<line:int,family:string,probability:double,similarity:double,confirmed:boolean,text:string>>"
)


def words_of(text: str) -> list[str]:
    """The words of a unit, as the arrays see them."""
    return FOLD[np.frombuffer(text.encode(), np.uint8)].tobytes().decode("utf-8", "replace").split()


def _pairs(words: list[str]) -> set[tuple[str, str]]:
    return set(zip(words, words[1:])) or {(w, "") for w in words}


def _grams(words: list[str]) -> list[str]:
    """The distinct words and pairs of a unit: a word that is repeated says no more than once."""
    return list(dict.fromkeys([*words, *(f"{a} {b}" for a, b in zip(words, words[1:]))]))


def similarity(words: list[str], template: set[tuple[str, str]]) -> float:
    """How much of the template a unit has, or how much of a stretch of the unit, with enough pairs, is the template's."""
    pairs = list(zip(words, words[1:])) or [(w, "") for w in words]
    hits = [i for i, p in enumerate(pairs) if p in template]
    if not hits:
        return 0.0
    whole = len({pairs[i] for i in hits}) / len(template)
    if len(hits) < min(MIN_PAIRS, len(template)):
        return whole
    # The stretch that has the most pairs of the template more than others.
    best, begin, total = 0.0, 0, 0
    for i, p in enumerate(pairs):
        total += 1 if p in template else -1
        if total <= 0:
            begin, total = i + 1, 0
        elif total >= min(MIN_PAIRS, len(template)) - 1:
            stretch = pairs[begin : i + 1]
            inside = sum(x in template for x in stretch)
            if inside >= min(MIN_PAIRS, len(template)):
                best = max(best, inside / len(stretch))
    return max(whole, best)


def _least(slope: float, intercept: float, probability: float) -> float:
    return (np.log(probability / (1 - probability)) - intercept) / slope if slope > 0 else -np.inf


def _parts(begin: int, end: int) -> list[tuple[int, int]]:
    """A range of words and its parts of `PART` words."""
    last = end - PART
    return [(begin, end), *((i, i + PART) for i in sorted({*range(begin, last, PART // 4), last}) if last > begin)]


def _stretch(words: list[str], template: set[tuple[str, str]]) -> tuple[int, int, int]:
    """The stretch of words that has the most pairs of the template more than others, each pair once, as another notice
    may begin with the same words: how many more, begin and end."""
    best, begin, total = (0, 0, 0), 0, 0
    seen: set[tuple[str, str]] = set()
    for i, p in enumerate(zip(words, words[1:])):
        total += 1 if p in template and p not in seen else -1
        seen.add(p)
        if total <= 0:
            begin, total, seen = i + 1, 0, set()
        elif total > best[0]:
            best = (total, begin, i + 2)
    return best


@dataclass
class Model:
    families: list[str]
    weights: dict[str, np.ndarray]  # word or pair -> one weight per family, and one for any licence
    bias: np.ndarray
    slope: float
    intercept: float
    any_slope: float
    any_intercept: float
    templates: list[list[set[tuple[str, str]]]]

    def scores(self, words: list[str]) -> np.ndarray:
        total = self.bias.copy()
        if words:
            found = [self.weights[g] for g in _grams(words) if g in self.weights]
            if found:
                total = total + np.sum(found, 0) / np.sqrt(len(words))
        return total

    def judge(self, words: list[str], min_probability: float) -> list[tuple[str, float, float]]:
        """Each family found, the best first, with its calibrated probability and the unit's similarity to the family's
        nearest template. The score is that of the unit, or of its part of `PART` words that scores best. The stretch of
        that part which a template of the family accounts for is set aside, and what is left is read again."""
        found: dict[int, float] = {}
        left = np.ones(len(words), bool)
        while left.any():
            edges = np.flatnonzero(np.diff(left, prepend=False, append=False)).reshape(-1, 2).tolist()
            parts = [part for x, y in edges for part in _parts(x, y)]
            scores = np.array([self.scores(words[x:y])[:-1] for x, y in parts])
            best, k = divmod(int(np.argmax(scores)), len(self.families))
            probability = float(sigmoid(self.slope * scores[best, k] + self.intercept))
            if probability < min_probability:
                break
            found.setdefault(k, probability)
            begin, end = next((x, y) for x, y in edges if x <= parts[best][0] < y)
            x, y = self._account(words[begin:end], k, min_probability)
            x, y = (begin + x, begin + y) if y else parts[best]
            left[x:y] = False
        return [(self.families[k], p, max(similarity(words, t) for t in self.templates[k])) for k, p in found.items()]

    def _account(self, words: list[str], k: int, min_probability: float) -> tuple[int, int]:
        """Begin and end of the stretch that a template of the family accounts for, one that is of the family by itself
        before others: read from either side, as a like notice of another family may stand beside it."""
        least, n, options = self.least_score(min_probability), len(words), [(False, 0, 0, 0)]
        for t in self.templates[k]:
            total, x, y = _stretch(words, t)
            back, u, v = _stretch(words[::-1], {p[::-1] for p in t})
            for more, i, j in ((total, x, y), (back, n - v, n - u)):
                if more > 0:
                    options.append((bool(self.scores(words[i:j])[k] >= least), more, i, j))
        return max(options)[2:]

    def unknown(self, words: list[str]) -> tuple[str, float, float]:
        """The calibrated probability of any licence at all, and the similarity to the nearest template of any family."""
        score = max(self.scores(words[x:y])[-1] for x, y in _parts(0, len(words)))
        alike = max(similarity(words, t) for family in self.templates for t in family)
        return UNKNOWN, float(sigmoid(self.any_slope * score + self.any_intercept)), alike

    def least_score(self, min_probability: float) -> float:
        """The score that a unit must reach to be predicted at all."""
        return _least(self.slope, self.intercept, min_probability)

    def least_scores(self, min_probability: float) -> np.ndarray:
        """The same for each family and for any licence."""
        any_licence = _least(self.any_slope, self.any_intercept, min_probability)
        return np.array([*[self.least_score(min_probability)] * len(self.families), any_licence])


def _examples(draw: random.Random, background: list[list[str]], families: list[str]) -> list[tuple[list[str], int]]:
    """Units and the number of their family, -1 for none."""
    out: list[tuple[list[str], int]] = []
    cut = lambda words, least: (lambda n: (lambda i: words[i : i + n])(draw.randint(0, len(words) - n)))(draw.randint(min(least, len(words)), len(words)))
    vocabulary = sorted({w for f in families for t in TEMPLATES[f] for w in words_of(t)})
    for k, family in enumerate(families):
        for template in TEMPLATES[family]:
            words = words_of(template)
            out += [(words, k)] * 6
            for _ in range(30):
                part = cut(words, max(5, 2 * len(words) // 3))
                out.append(([w for w in part if draw.random() > 0.05] or part, k))
            for _ in range(40):
                # Within other text, up to a whole window of it.
                inside = cut(words, max(5, min(len(words), 16)))[:WINDOW]
                around = [w for _ in range(4) for w in draw.choice(background)][: draw.randint(0, WINDOW - len(inside))]
                spot = draw.randint(0, len(around))
                out.append((around[:spot] + inside + around[spot:], k))
            for _ in range(8):
                mixed = words[:]
                draw.shuffle(mixed)
                out.append((mixed[: max(2, len(mixed) // 2)], -1))
    for sentence in OTHER_SENSES:
        words = words_of(sentence)
        out += [(words, -1)] * 6 + [(cut(words, 4), -1) for _ in range(10)]
    for _ in range(600):
        out.append(([draw.choice(vocabulary) for _ in range(draw.randint(1, 10))], -1))
    for line in background:
        out.append((line[:WINDOW], -1))
        spot = draw.randint(0, len(line))
        out.append((line[:spot][-WINDOW // 2 :] + [draw.choice(vocabulary) for _ in range(draw.randint(1, 3))] + line[spot:][: WINDOW // 2], -1))
    return out


def train(documents: DataFrame, rows: int = BACKGROUND_ROWS) -> Model:
    """Fit on the templates, with lines of at most so many documents as background."""
    # The ids are chosen first: each task sends the driver its candidates, and texts would add up.
    chosen = hash_sample(documents.where("doc_id is not null and text is not null").select("doc_id"), "doc_id", rows)
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen.distinct()), "doc_id").select("text").limit(rows)
    return fit([r["text"] for r in texts.collect()])


def fit(texts: list[str]) -> Model:
    """The model, with the lines of these texts as background."""
    lines = sorted({line for text in texts for line in text.split("\n")})
    families = list(TEMPLATES)
    templates = [[_pairs(words_of(t)) for t in TEMPLATES[f]] for f in families]
    every = set().union(*[t for f in templates for t in f])
    draw = random.Random(_SEED)
    draw.shuffle(lines)
    background = [words for line in lines[:BACKGROUND_LINES] if (words := words_of(line)) and len(_pairs(words) & every) < 0.3 * len(_pairs(words))]
    examples = _examples(draw, background or [words_of(s) for s in OTHER_SENSES], families)
    draw.shuffle(examples)
    known = {w for t in TEMPLATES.values() for x in t for w in words_of(x)}
    known |= {f"{a} {b}" for t in TEMPLATES.values() for x in t for a, b in zip(words_of(x), words_of(x)[1:])}
    known |= {w for s in OTHER_SENSES for w in words_of(s)}
    number = {g: i for i, g in enumerate(sorted(known))}
    row, column, value = [], [], []
    for i, (words, _) in enumerate(examples):
        for g in _grams(words):
            if g in number:
                row.append(i)
                column.append(number[g])
                value.append(1 / np.sqrt(len(words)))
    row, column, value = np.array(row), np.array(column), np.array(value)
    label = np.array([k for _, k in examples])
    held = np.arange(len(examples)) % 4 == 3
    place = np.cumsum(~held) - 1
    fit = ~held[row]
    weights, bias = np.zeros((len(number), len(families) + 1)), np.zeros(len(families) + 1)
    for k in range(len(families) + 1):
        y = (label[~held] == k if k < len(families) else label[~held] >= 0).astype(float)
        weights[:, k], bias[k] = fit_logistic(place[row[fit]], column[fit], value[fit], y, len(number), l1=2e-4, l2=1e-5, steps=150)
    scores = np.tile(bias, (len(examples), 1))
    np.add.at(scores, row, weights[column] * value[:, None])
    best = scores[:, :-1].argmax(1)
    slope, intercept = fit_platt(scores[:, :-1].max(1)[held], (best == label)[held].astype(float))
    any_licence = fit_platt(scores[held, -1], (label >= 0)[held].astype(float))
    kept = {g: weights[i] for g, i in number.items() if np.any(weights[i])}
    return Model(families, kept, bias, slope, intercept, *any_licence, templates)


def _windows(first: np.ndarray, last: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word and end word of the windows over each range of words, and the number of the range."""
    step = WINDOW // 2
    parts = np.where(last - first <= WINDOW, 1, -(-(last - first - WINDOW) // step) + 1)
    which = np.repeat(np.arange(len(first)), parts)
    k = np.arange(len(which)) - np.repeat(np.cumsum(parts) - parts, parts)
    begin = first[which] + k * step
    return begin, np.minimum(begin + WINDOW, last[which]), which


def _units(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, end word and line number of the first word of each unit of a batch, in order."""
    starts, ends, rows, _ = batch.lines()
    first, last = np.searchsorted(batch.starts, starts), np.searchsorted(batch.starts, ends)
    number = np.arange(len(rows)) - np.searchsorted(rows, rows)
    full = last > first
    # A paragraph begins with a text and after a line without words.
    opens = full & np.concatenate(([True], (rows[1:] != rows[:-1]) | ~full[:-1]))[: len(full)]
    paragraph = np.cumsum(opens)[full] - 1
    first, last, number = first[full], last[full], number[full]
    begin, end, line = _windows(first, last)
    head = np.flatnonzero(np.diff(paragraph, prepend=-1))
    tail = np.append(head[1:], len(first))[: len(head)] - 1
    wide, close, _ = _windows(first[head], last[tail])
    at = np.searchsorted(last, wide, side="right")  # the line of the first word
    across = close > last[at] if len(at) else np.zeros(0, bool)
    begin, end, line = (np.concatenate(x) for x in ((begin, wide[across]), (end, close[across]), (line, at[across])))
    order = np.lexsort((end, begin))
    return begin[order], end[order], number[line[order]]


class Reach:
    """Which units could be predicted: for each family, the positive weights of a unit's words and of its pairs as they
    stand, over the root of the shortest part that may hold them, against the score to reach."""

    def __init__(self, model: Model, min_probability: float):
        words = sorted({w for gram in model.weights for w in gram.split()})
        hashes = Batch(pa.array([" ".join(words)])).word_hashes()
        order = np.argsort(hashes)
        self.table = hashes[order]
        number = {words[k]: i for i, k in enumerate(order)}
        size = len(model.bias)
        self.alone = np.zeros((len(words), size), np.float32)
        pairs = {}
        for gram, weight in model.weights.items():
            first, *second = gram.split()
            if second:
                pairs[number[first] * len(words) + number[second[0]]] = np.maximum(weight, 0)
            else:
                self.alone[number[first]] = np.maximum(weight, 0)
        self.pairs = np.array(sorted(pairs), np.int64)
        self.together = np.array([pairs[p] for p in self.pairs], np.float32).reshape(len(pairs), size)
        self.least = (model.least_scores(min_probability) - model.bias).astype(np.float32)

    def may(self, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        place = np.minimum(np.searchsorted(self.table, hashes), len(self.table) - 1)
        place = np.where(self.table[place] == hashes, place, -1)
        sums = np.zeros((len(begin), len(self.least)), np.float32)
        known = np.flatnonzero(place >= 0)
        self._add(sums, known, self.alone[place[known]], begin, end)
        both = known[(known + 1 < len(place)) & (place[np.minimum(known + 1, len(place) - 1)] >= 0)]
        pair = place[both] * len(self.table) + place[both + 1] if len(both) else both
        at = np.minimum(np.searchsorted(self.pairs, pair), len(self.pairs) - 1)
        hit = self.pairs[at] == pair
        self._add(sums, both[hit], self.together[at[hit]], begin, end)
        root = np.sqrt(np.clip(end - begin, 1, PART)).astype(np.float32)
        return ((sums / root[:, None]) >= self.least - 1e-3).any(1)

    @staticmethod
    def _add(sums: np.ndarray, at: np.ndarray, weights: np.ndarray, begin: np.ndarray, end: np.ndarray) -> None:
        """Add up the weights, given by place, over each unit."""
        total = np.concatenate((np.zeros((1, weights.shape[1])), np.cumsum(weights, axis=0, dtype=np.float64)))
        sums += total[np.searchsorted(at, end)] - total[np.searchsorted(at, begin)]


def scan(documents: DataFrame, model: Model, min_probability: float = MIN_PROBABILITY, min_similarity: float = MIN_SIMILARITY) -> DataFrame:
    """One row per document: its licence family (null: none), that of its best confirmed finding, and all findings."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    finding = pa.struct(
        [("line", pa.int32()), ("family", pa.string()), ("probability", pa.float64()), ("similarity", pa.float64()), ("confirmed", pa.bool_()), ("text", pa.string())]
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = shared.value
        reach = Reach(m, min_probability)
        for rows in batches:
            for a, b in slices(rows["text"]):
                plain = Batch(rows["text"].slice(a, b - a))
                batch = Batch.of(FOLD[plain.data], plain.doc_bounds)
                begin, end, line = _units(batch)
                data, raw = batch.data.tobytes(), plain.data.tobytes()
                each: list[list[dict]] = [[] for _ in range(batch.rows)]
                chosen = np.flatnonzero(reach.may(batch.word_hashes(), begin, end))
                judged = []
                named = np.zeros(len(batch.starts), bool)
                for u in chosen:
                    x, y = int(batch.starts[begin[u]]), int(batch.ends[end[u] - 1])
                    words = data[x:y].decode("utf-8", "replace").split()
                    judged.append((u, x, y, words, m.judge(words, min_probability)))
                    if judged[-1][-1]:
                        named[begin[u] : end[u]] = True
                for u, x, y, words, families in judged:
                    # A piece of a notice that another unit has whole is not of an unknown licence.
                    if not families and not named[begin[u] : end[u]].any():
                        families = [f for f in [m.unknown(words)] if f[1] >= min_probability]
                    for family, probability, alike in families:
                        each[int(batch.word_row[begin[u]])].append(
                            {
                                "line": int(line[u]),
                                "family": family,
                                "probability": probability,
                                "similarity": alike,
                                "confirmed": family != UNKNOWN and alike >= min_similarity,
                                "text": raw[x:y].decode("utf-8", "replace"),
                            }
                        )
                best = [max(f, key=lambda r: (r["confirmed"], r["probability"]), default=None) for f in each]
                best = [r if r and r["confirmed"] else None for r in best]
                pick = lambda name: [r and r[name] for r in best]
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"].slice(a, b - a),
                        pa.array(pick("family"), pa.string()),
                        pa.array(pick("probability"), pa.float64()),
                        pa.array(pick("similarity"), pa.float64()),
                        pa.array([r is not None for r in best]),
                        pa.array(each, pa.list_(finding)),
                    ],
                    ["doc_id", "family", "probability", "similarity", "confirmed", "findings"],
                )

    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, RESULT)
