"""Quality rules: counts over a whole text with fixed limits, then a classifier trained on labelled quality.

The classifier is a logistic regression over hashed word n-grams (one and two words) and character n-grams (three and
four bytes of UTF-8), each as a share of its kind in the text, so that long and short texts compare. It is fitted on a
bounded sample of labelled rows, calibrated on the part of the sample that the fit left out, and applied to Arrow
batches. Every word of every text counts.

Null or empty text: no words, hence base_failed. Very long texts: counted and scored whole. Ties: a share or probability
that is exactly at its limit is kept. Empty tables give no rows. Null doc_id: passed on. Repeated rows: each gets its own result. No
labels, or one class only: the classifier keeps everything and only the base rules reject. Extra columns are ignored by
`score` and passed on by `filter_quality`.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import hash_sample, ship_package, slices
from fleetpulse.llm.linear import fit_logistic, fit_platt, row_sums, sigmoid
from fleetpulse.llm.text import U64, Batch, occurrence, windows

#: Labelled rows to fit on, at most; a third of them calibrates.
TRAINING_ROWS = 2400
BITS = 16
SIZE = 1 << BITS
MIN_WORDS = 20
REPEAT_WINDOW = 8
MAX_REPEAT_PERCENT = 30
MIN_PROBABILITY = 0.5
_SCALE = 10.0
_SYMBOL = np.zeros(256, np.uint8)
_SYMBOL[list(b"#*$%&|<>")] = 1
_CODE_POINT = (np.arange(256) & 0xC0 != 0x80).astype(np.uint8)
_CODE_POINT[[9, 10, 11, 12, 13, 32]] = 0

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
SCORED = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, " \
    "base_failed boolean, probability double, kept boolean"


@dataclass
class Model:
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float


def counts(batch: Batch, hashes: np.ndarray) -> dict[str, np.ndarray]:
    """The five counts of each text."""
    starts, ends, line_rows, line_words = batch.lines()
    full = line_words > 0
    repeated_line = occurrence(batch.hashes(starts[full], ends[full]), line_rows[full]) > 0
    grams, at = windows(hashes, batch.word_row, REPEAT_WINDOW)
    key = grams ^ (batch.word_row[at].astype(U64) * U64(0xA24BAED4963EE407))
    _, inverse, times = np.unique(key, return_inverse=True, return_counts=True)
    twice = at[times[inverse] > 1]
    edge = np.zeros(len(hashes) + 1, np.int64)
    np.add.at(edge, twice, 1)
    np.add.at(edge, twice + REPEAT_WINDOW, -1)
    covered = np.cumsum(edge)[: len(hashes)] > 0
    return {
        "n_words": np.diff(batch.word_bounds),
        "word_chars": batch.per_row(_CODE_POINT[batch.data]),
        "n_symbols": batch.per_row(_SYMBOL[batch.data]),
        "n_dup_lines": np.bincount(line_rows[full], repeated_line, batch.rows).astype(np.int64),
        "n_repeat_words": np.bincount(batch.word_row, covered, batch.rows).astype(np.int64),
    }


def _features(batch: Batch, hashes: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """For each kind of n-gram its columns, in order of text, and the bounds of each text among them."""
    one = (hashes >> U64(64 - BITS)).astype(np.int64)
    yield one, batch.word_bounds
    pair, at = windows(hashes, batch.word_row, 2)
    yield (pair >> U64(64 - BITS)).astype(np.int64) + SIZE, np.searchsorted(at, batch.word_bounds)
    data = np.concatenate((batch.data, np.zeros(4, np.uint8))).astype(np.uint32)
    three = data[:-2] | data[1:-1] << np.uint32(8) | data[2:] << np.uint32(16)
    four = three[:-1] | data[3:] << np.uint32(24)
    for k, (gram, width) in enumerate(((three, 3), (four, 4))):
        column = (gram[: len(batch.data)] * np.uint32(2654435761) >> np.uint32(32 - BITS)).astype(np.int64)
        lasts = np.maximum(batch.doc_bounds[1:] - width + 1, batch.doc_bounds[:-1])
        yield column + (2 + k) * SIZE, np.column_stack((batch.doc_bounds[:-1], lasts))


def _margins(batch: Batch, hashes: np.ndarray, model: Model) -> np.ndarray:
    out = np.full(batch.rows, model.bias)
    for columns, bounds in _features(batch, hashes):
        sums = np.concatenate(([0.0], np.cumsum(model.weights[columns], dtype=np.float64)))
        low, high = (bounds[:-1], bounds[1:]) if bounds.ndim == 1 else bounds.T
        out += _SCALE * (sums[high] - sums[low]) / np.maximum(high - low, 1)
    return out


def _sparse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for a, b in slices(rows["text"]):
            batch = Batch(rows["text"].slice(a, b - a))
            columns, values = [[] for _ in range(batch.rows)], [[] for _ in range(batch.rows)]
            for found, bounds in _features(batch, batch.word_hashes()):
                pairs = zip(bounds[:-1], bounds[1:]) if bounds.ndim == 1 else bounds
                for i, (low, high) in enumerate(pairs):
                    column, times = np.unique(found[low:high], return_counts=True)
                    columns[i].append(column)
                    values[i].append(_SCALE * times / max(high - low, 1))
            yield pa.RecordBatch.from_arrays(
                [
                    rows["quality"].slice(a, b - a),
                    pa.array([np.concatenate(c) for c in columns], pa.list_(pa.int32())),
                    pa.array([np.concatenate(v) for v in values], pa.list_(pa.float32())),
                ],
                ["quality", "columns", "values"],
            )


def _part(found: pa.Table, chosen: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, column and value of each entry of the chosen rows."""
    sizes, columns, values, start = [np.zeros(0, np.int64)], [np.zeros(0, np.int32)], [np.zeros(0, np.float32)], 0
    for rows in found.select(["columns", "values"]).to_batches():
        size = pc.list_value_length(rows["columns"]).to_numpy()
        use = chosen[start : start + len(size)]
        entries = np.repeat(use, size)
        sizes.append(size[use])
        columns.append(rows["columns"].flatten().to_numpy()[entries])
        values.append(rows["values"].flatten().to_numpy()[entries])
        start += len(size)
    size = np.concatenate(sizes)
    return np.repeat(np.arange(len(size), dtype=np.int32), size), np.concatenate(columns), np.concatenate(values)


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Fit on at most so many labelled rows; None without two classes."""
    ship_package(documents.sparkSession)
    chosen = hash_sample(
        labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)"),
        "doc_id",
        rows,
    )
    texts = documents.select("doc_id", "text").join(F.broadcast(chosen), "doc_id").select("quality", "text")
    found = texts.mapInArrow(_sparse, "quality int, columns array<int>, values array<float>").toArrow()
    y = found["quality"].to_numpy().astype(float)
    if not (0 < y.sum() < len(y)):
        return None
    fold = np.argsort(np.argsort(-y, kind="stable"), kind="stable") % 3  # both classes in each part
    held = fold == 2
    if not (0 < y[held].sum() < held.sum() and 0 < y[~held].sum() < (~held).sum()):
        held = np.zeros(len(y), bool)
    # The sample is the most that the driver ever holds: each part of it is there once.
    fitted, left_out = _part(found, ~held), _part(found, held)
    del found
    pa.default_memory_pool().release_unused()
    weights, bias = fit_logistic(*fitted, y[~held], 4 * SIZE, l2=1e-6, steps=100)
    check = held if held.any() else ~held
    margin = row_sums(*(left_out if held.any() else fitted), weights, check.sum()) + bias
    slope, intercept = fit_platt(margin, y[check])
    return Model(weights.astype(np.float32), bias, slope, intercept)


def _scorer(model: Broadcast, limits: dict):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model | None = model.value
        for rows in batches:
            for a, b in slices(rows["text"]):
                batch = Batch(rows["text"].slice(a, b - a))
                hashes = batch.word_hashes()
                found = counts(batch, hashes)
                probability = sigmoid(m.slope * _margins(batch, hashes, m) + m.intercept) if m else np.ones(batch.rows)
                failed = (found["n_words"] < limits["min_words"]) | (
                    100 * found["n_repeat_words"] > limits["max_repeat_percent"] * found["n_words"]
                )
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"].slice(a, b - a),
                        *[pa.array(found[c].astype(np.int64)) for c in COUNTS],
                        pa.array(failed),
                        pa.array(probability),
                        pa.array(~failed & (probability >= limits["min_probability"])),
                    ],
                    ["doc_id", *COUNTS, "base_failed", "probability", "kept"],
                )

    return run


def _limits(min_words: int, max_repeat_percent: int, min_probability: float) -> dict:
    return {"min_words": min_words, "max_repeat_percent": max_repeat_percent, "min_probability": min_probability}


def score(
    documents: DataFrame,
    model: Model | None,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """One row per document: counts, base_failed, the calibrated probability of good quality, kept."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    run = _scorer(shared, _limits(min_words, max_repeat_percent, min_probability))
    return documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, SCORED)


def filter_quality(
    documents: DataFrame,
    model: Model | None,
    min_words: int = MIN_WORDS,
    max_repeat_percent: int = MAX_REPEAT_PERCENT,
    min_probability: float = MIN_PROBABILITY,
) -> DataFrame:
    """The documents that the rules keep, with all their columns."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)
    judge = _scorer(shared, _limits(min_words, max_repeat_percent, min_probability))
    text, doc_id = documents.columns.index("text"), documents.columns.index("doc_id")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            narrow = pa.RecordBatch.from_arrays([rows.column(doc_id), rows.column(text)], ["doc_id", "text"])
            kept = pa.concat_arrays([verdict["kept"] for verdict in judge(iter([narrow]))] or [pa.array([], pa.bool_())])
            yield rows.filter(kept)

    return documents.mapInArrow(run, documents.schema)
