"""Toxicity by a support vector machine over a gapped subsequence kernel of words, with Nystroem landmarks.

A string is a word in lower case without ASCII punctuation, so that dots or dashes put between letters go; letters that
stand alone, with blanks put between them, are one word. Its features
are subsequences of three and of four characters (word ends count as characters) within a window, weighted by a decay for
each character skipped; the kernel of two strings is the product of these vectors, each divided by a norm that depends on
the string's length. An insult with a character put in keeps most of its subsequences.

Labels are given for texts, while an insult is a word: a text is as toxic as its worst word, and the machine is trained
on the worst words of toxic texts (chosen anew in each round) against the worst words of clean ones. Landmarks are chosen
among them; in their Nystroem space the machine is linear, and its decision function adds up to one weight per
subsequence, so that scoring is one pass over all windows of a text, in arrays.

Null or empty text: no words, the lowest margin, hence a score near 0. Very long texts: scored whole, one at a time, in
some hundred bytes of memory per character. Null doc_id: passed on, not held out. Repeated rows: each is scored. Ties of
the worst word: any of them, as only its margin counts. No labels, or one class only: all scores are 0. Extra columns are
ignored. Empty tables give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import hash_sample, ship_package, slices
from fleetpulse.llm.linear import fit_platt, sigmoid

#: Labelled texts to fit on, at most, of each class.
TRAINING_ROWS = 1500
LANDMARKS = 160
ROUNDS = 4
BITS = 20
DECAY = 0.7
HELD_OUT = 5
_LOWEST = -3.0
# Offsets of the characters after the first, within five characters for three and within six for four.
PATTERNS = [(a, b) for b in range(2, 5) for a in range(1, b)]
PATTERNS += [(a, b, c) for c in range(3, 6) for b in range(2, c) for a in range(1, b)]
_GAPS = np.array([p[-1] - len(p) for p in PATTERNS])
_SPANS = np.array([p[-1] + 1 for p in PATTERNS])
_FACTORS = np.array([0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D, 0x27D4EB2F], np.uint32)
_DROPPED = np.zeros(128, bool)
_DROPPED[[c for c in range(33, 127) if not chr(c).isalnum()]] = True
_BLANK = np.zeros(128, bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float


class Strings:
    """The words of some texts in one array of code points, each between two blanks."""

    def __init__(self, texts: list[str], joined: bool = True):
        lower = [t.lower() for t in texts]
        codes = np.frombuffer(" ".join(["", *lower, ""]).encode("utf-32-le", "surrogatepass"), np.uint32)
        bounds = np.cumsum([0, *[len(t) + 1 for t in lower]])  # the blank before each text
        ascii_code = np.minimum(codes, 127)
        dropped = (codes < 128) & _DROPPED[ascii_code]
        blank = (codes < 128) & _BLANK[ascii_code]
        kept = np.flatnonzero(~dropped)
        blank = blank[kept]
        # Blanks in a row count once.
        first = blank & ~np.concatenate(([False], blank[:-1]))
        use = first | ~blank
        self.codes = np.where(blank[use], 32, codes[kept[use]]).astype(np.uint32)
        place = np.searchsorted(kept[use], bounds[:-1], side="right") - 1
        # Letters that stand alone, one after the other in a text, are one word.
        self.blanks = np.flatnonzero(self.codes == 32)
        alone = np.diff(self.blanks) == 2
        within = np.setdiff1d(self.blanks[1:-1][alone[:-1] & alone[1:]], place)
        if joined and len(within):
            self.codes = np.delete(self.codes, within)
            place = place - np.searchsorted(within, place)
            self.blanks = np.flatnonzero(self.codes == 32)
        self.words = len(self.blanks) - 1
        self.lengths = np.diff(self.blanks) - 1
        # Words of text i: from the blank at or before its beginning.
        self.first_word = np.searchsorted(self.blanks, place)
        self.norms = np.sqrt(np.maximum((DECAY ** (2 * _GAPS) * np.maximum(self.lengths[:, None] + 3 - _SPANS, 0)).sum(1), 1e-9))

    def windows(self) -> Iterator[tuple[float, np.ndarray, np.ndarray]]:
        """For each pattern its weight, the feature of each window by its first place, and whether it lies in a word."""
        n = len(self.codes)
        after = np.repeat(np.concatenate((self.blanks[1:], [n])), np.diff(np.concatenate((self.blanks, [n]))))
        for pattern, gaps in zip(PATTERNS, _GAPS):
            m = n - pattern[-1]
            if m <= 0:
                continue
            h = self.codes[:m] * _FACTORS[0]
            for k, offset in enumerate(pattern):
                h ^= (self.codes[offset : offset + m] + np.uint32(k + 1)) * _FACTORS[k + 1]
                h *= np.uint32(0x2C1B3C6D)
                h ^= h >> np.uint32(15)
            yield DECAY**gaps, h >> np.uint32(32 - BITS), np.arange(pattern[-1], n) <= after[:m]

    def margins(self, weights: np.ndarray) -> np.ndarray:
        """Of each word, without the bias."""
        if not self.words:
            return np.zeros(0)
        total = np.zeros(len(self.codes), np.float32)
        for decay, feature, inside in self.windows():
            total[: len(feature)] += np.where(inside, weights[feature], 0) * np.float32(decay)
        return np.add.reduceat(total, self.blanks)[:-1] / self.norms

    def features(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word, feature and value of each window, for the few strings that the fit looks at."""
        word = np.repeat(np.arange(len(self.blanks)), np.diff(np.concatenate((self.blanks, [len(self.codes)]))))
        out = []
        for decay, feature, inside in self.windows():
            at = np.flatnonzero(inside)
            out.append((word[at], feature[at].astype(np.int64), decay / self.norms[np.minimum(word[at], self.words - 1)]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def worst(self, margins: np.ndarray) -> np.ndarray:
        """The highest margin among the words of each text; `_LOWEST` where there is none."""
        ends = np.concatenate((self.first_word[1:], [self.words]))
        out = np.full(len(self.first_word), _LOWEST)
        for i in np.flatnonzero(ends > self.first_word):
            out[i] = margins[self.first_word[i] : ends[i]].max()
        return out


def is_held_out(doc_id: str = "doc_id") -> Column:
    """Rows that never teach: crc32 of the id as text leaves 0 when divided by five."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % HELD_OUT == 0, F.lit(False))


def _bags(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The distinct strings of each text."""
    for rows in batches:
        bags = []
        for text in rows["text"].to_pylist():
            strings = Strings([text or ""])
            clean = strings.codes.tobytes().decode("utf-32-le", "surrogatepass")
            bags.append(sorted({w for w in clean.split(" ") if w}))
        yield pa.RecordBatch.from_arrays([rows["toxic"], pa.array(bags, pa.list_(pa.string()))], ["toxic", "bag"])


def _kernel(words: list[str], landmarks: list[str]) -> np.ndarray:
    """The kernel of each word with each landmark."""
    lrow, lcol, lval = Strings([" ".join(landmarks)], joined=False).features()
    known, place = np.unique(lcol, return_inverse=True)
    table = np.zeros((len(known), len(landmarks)), np.float32)
    np.add.at(table, (place, lrow), lval)
    out = np.zeros((len(words), len(landmarks)), np.float32)
    for a in range(0, len(words), 1000):
        row, col, val = Strings([" ".join(words[a : a + 1000])], joined=False).features()
        at = np.minimum(np.searchsorted(known, col), len(known) - 1)
        hit = known[at] == col
        np.add.at(out, a + row[hit], table[at[hit]] * val[hit, None].astype(np.float32))
    return out


def _machine(z: np.ndarray, y: np.ndarray, share: np.ndarray, steps: int = 300) -> tuple[np.ndarray, float]:
    """A linear support vector machine with squared hinge loss, by Adam on all rows."""
    w, b = np.zeros(z.shape[1]), 0.0
    m, v, mb, vb = np.zeros_like(w), np.zeros_like(w), 0.0, 0.0
    for t in range(1, steps + 1):
        slack = np.maximum(0, 1 - y * (z @ w + b)) * y * share
        g, gb = -2 * (z.T @ slack) + 2e-4 * w, -2 * slack.sum()
        m, v, mb, vb = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g**2, 0.9 * mb + 0.1 * gb, 0.99 * vb + 0.01 * gb**2
        rate = 0.1 / (1 + t / 60)
        w -= rate * (m / (1 - 0.9**t)) / (np.sqrt(v / (1 - 0.99**t)) + 1e-9)
        b -= rate * (mb / (1 - 0.9**t)) / (np.sqrt(vb / (1 - 0.99**t)) + 1e-9)
    return w, b


def fit(bags: list[list[str]], labels: np.ndarray, landmarks: int = LANDMARKS) -> Model | None:
    """The machine from labelled bags of strings: taught by all of them, and calibrated on the margins that each third gets
    from a machine taught by the others, so that few labels go a long way."""
    labels = np.asarray(labels)
    full = np.array([bool(b) for b in bags], bool)
    if not _both(labels[full]):
        return None
    vocabulary = sorted(set().union(*[bags[i] for i in np.flatnonzero(full)]))
    number = {w: i for i, w in enumerate(vocabulary)}
    coded = [np.array([number[w] for w in b], np.int64) for b in bags]
    strings = Strings([" ".join(vocabulary)], joined=False)

    def worst(of: tuple[np.ndarray, float], rows: np.ndarray) -> np.ndarray:
        margins = strings.margins(of[0]) + of[1]
        return np.array([margins[coded[i]].max() if len(coded[i]) else _LOWEST for i in rows])

    fold = np.zeros(len(bags), int)
    for c in (0, 1):
        at = np.flatnonzero((labels > 0) == bool(c))
        fold[at] = np.arange(len(at)) % 3
    left_out = np.full(len(bags), np.nan)
    for f in range(3):
        teach = full & (fold != f)
        others = np.flatnonzero(fold == f)
        machine = _taught(strings, vocabulary, coded, labels, teach, landmarks) if _both(labels[teach]) else None
        if machine is not None:
            left_out[others] = worst(machine, others)
    machine = _taught(strings, vocabulary, coded, labels, full, landmarks)
    if machine is None:
        return None
    known = ~np.isnan(left_out)
    if not _both(labels[known]):
        known, left_out = np.ones(len(bags), bool), worst(machine, np.arange(len(bags)))
    return Model(machine[0], float(machine[1]), *fit_platt(left_out[known], labels[known].astype(float)))


def _both(labels: np.ndarray) -> bool:
    return bool((labels > 0).any() and (labels <= 0).any())


def _taught(strings: Strings, vocabulary: list[str], coded: list[np.ndarray], labels: np.ndarray, teach: np.ndarray, landmarks: int) -> tuple[np.ndarray, float] | None:
    """Weights and bias learned from some of the bags."""
    toxic = [coded[i] for i in np.flatnonzero(teach & (labels > 0))]
    clean = [coded[i] for i in np.flatnonzero(teach & (labels <= 0))]
    in_toxic = np.bincount(np.concatenate(toxic), minlength=len(vocabulary))
    in_clean = np.bincount(np.concatenate(clean), minlength=len(vocabulary))
    # To begin with, a subsequence weighs the more the more often it is in toxic texts than in clean ones.
    word = np.repeat(np.arange(strings.words + 1), np.diff(np.concatenate((strings.blanks, [len(strings.codes)]))))
    word = np.minimum(word, strings.words - 1)
    bad, good = np.zeros(1 << BITS), np.zeros(1 << BITS)
    for _, feature, inside in strings.windows():
        at = np.flatnonzero(inside)
        bad += np.bincount(feature[at], in_toxic[word[at]], 1 << BITS)
        good += np.bincount(feature[at], in_clean[word[at]], 1 << BITS)
    odds = np.log((bad / len(toxic) + 0.5 / len(toxic)) / (good / len(clean) + 0.5 / len(toxic)))
    weights, bias = np.maximum(np.where(bad >= 3, odds, 0), 0).astype(np.float32), 0.0
    only_clean = np.flatnonzero(in_clean > 0)
    found = None
    for _ in range(ROUNDS):
        margins = strings.margins(weights)
        witness = np.array([b[np.argmax(margins[b])] for b in toxic])
        chosen, times = np.unique(witness, return_counts=True)
        hard = only_clean[np.argsort(-margins[only_clean], kind="stable")[:3000]]
        spread = only_clean[:: max(1, len(only_clean) // 3000)][:3000]
        negative = np.unique(np.concatenate((hard, spread)))
        # A word of clean texts that is the worst of a toxic one tells that the label is not about this word.
        positive = ~np.isin(chosen, negative) | (times > in_clean[chosen])
        chosen, times = chosen[positive], times[positive]
        negative = np.setdiff1d(negative, chosen)
        if not len(chosen) or not len(negative):
            break
        marks = [vocabulary[i] for i in chosen[np.argsort(-times, kind="stable")[: landmarks * 3 // 4]]]
        marks += [vocabulary[i] for i in hard[: landmarks - len(marks)] if vocabulary[i] not in marks]
        words = [vocabulary[i] for i in np.concatenate((chosen, negative))]
        values, vectors = np.linalg.eigh(_kernel(marks, marks).astype(float))
        use = values > 1e-6 * values.max()
        whiten = vectors[:, use] / np.sqrt(values[use])
        z = _kernel(words, marks).astype(float) @ whiten
        y = np.concatenate((np.ones(len(chosen)), -np.ones(len(negative))))
        share = np.concatenate((0.5 * times / times.sum(), np.full(len(negative), 0.5 / len(negative))))
        w, bias = _machine(z, y, share)
        beta = whiten @ w
        row, col, val = Strings([" ".join(marks)], joined=False).features()
        weights = np.bincount(col, beta[row] * val, 1 << BITS).astype(np.float32)
        found = weights, bias
    return found


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Fit on at most so many labelled texts of each class, none of which is held out."""
    ship_package(documents.sparkSession)
    known = labels.select("doc_id", F.col("toxic").cast("int").alias("toxic")).where("doc_id is not null and toxic in (0, 1)")
    known = known.where(~is_held_out())
    chosen = hash_sample(known.where("toxic = 1"), "doc_id", rows).unionByName(hash_sample(known.where("toxic = 0"), "doc_id", rows))
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("toxic", "text")
    found = texts.mapInArrow(_bags, "toxic int, bag array<string>").toArrow()
    return fit(found["bag"].to_pylist(), found["toxic"].to_numpy())


def score(documents: DataFrame, model: Model | None, threshold: float = 0.5) -> DataFrame:
    """doc_id, held_out, score and predicted for each document, from its whole text."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows in batches:
            for a, b in slices(rows["text"], 1 << 19):
                texts = [t or "" for t in rows["text"].slice(a, b - a).to_pylist()]
                if m is None:
                    found = np.zeros(len(texts))
                else:
                    strings = Strings(texts)
                    found = sigmoid(m.slope * strings.worst(strings.margins(m.weights) + m.bias) + m.intercept)
                yield pa.RecordBatch.from_arrays([rows["doc_id"].slice(a, b - a), pa.array(found)], ["doc_id", "score"])

    narrow = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    scored = narrow.mapInArrow(run, "doc_id long, score double")
    return scored.select(
        "doc_id",
        is_held_out().alias("held_out"),
        "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"),
    )
