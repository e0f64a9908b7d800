"""Document fingerprints by winnowing, and how alike two of them are.

A text's grams are its ranges of GRAM consecutive code points, known by a rolling 64-bit hash (a polynomial over bytes,
read off prefix sums). Of every WINDOW consecutive grams the one of least hash is kept, the rightmost among equal ones,
with its position. A choice depends on its window only, so texts that share GRAM + WINDOW - 1 code points in a row share
a kept gram, wherever the passage stands. The order of hashes is that of their upper halves, which leaves room for the
position in the same number: a window's minimum is then a minimum of numbers. Likeness is the Jaccard similarity of the
sets of kept hashes.

`compare_next` needs each document beside the next one in descending order of id. Texts are dealt once, by ranges of the
id, and read in order; the last document of a range meets the first of the next in a join of one row per range.

Null text: empty. Empty text: no grams, an empty fingerprint, and as alike as can be (1) to another empty one and not at
all (0) to any other. Texts shorter than a gram: one gram, the whole text; with fewer grams than a window: one window.
Very long texts: taken whole, in a working set of about a hundred bytes per byte of text. Null doc_id: after all other ids. Ties
of doc_id: in order of the text's hash; equal rows are documents one after the other, and the next of a single document is
itself. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fleetpulse.llm.common import ship_package, slices, stored
from fleetpulse.llm.text import U64, Batch, mix

#: Code points of a gram, and grams of a window: a shared passage of 95 code points shares a kept gram.
GRAM = 32
WINDOW = 64
_ROW = U64(0xA0761D6478BD642F)
_LOW = U64(0xFFFFFFFF)
PRINTS = "hashes array<long>, positions array<int>"
COMPARED = (
    "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double"
)
# A row of one range: a finished document, the first document of the range (for the range before), or the last.
_PART = f"kind string, part int, {COMPARED}, text string"


class Prints:
    """The kept grams of a batch of texts: hash, position (code point) and text of each, in order."""

    def __init__(self, texts: pa.Array, gram: int = GRAM, window: int = WINDOW):
        batch = Batch(texts)
        first = np.flatnonzero(batch.data & 0xC0 != 0x80)  # where code points begin
        bounds = np.searchsorted(first, batch.doc_bounds)
        self.rows, self.chars = batch.rows, np.diff(bounds)
        ends = np.concatenate((first, [len(batch.data)]))
        # Each text's grams lie one after the other: those of short texts are the text itself.
        grams = np.where(self.chars > 0, np.maximum(self.chars - gram + 1, 1), 0)
        gram_bounds = np.concatenate(([0], np.cumsum(grams)))
        place = np.arange(gram_bounds[-1]) - np.repeat(gram_bounds[:-1], grams)
        start = np.repeat(bounds[:-1], grams) + place
        stop = np.minimum(start + gram, np.repeat(bounds[1:], grams))
        hashes = batch.hashes(ends[start], ends[stop])
        kept = self._kept(hashes, place, gram_bounds, window)
        self.hashes, self.positions = hashes[kept], place[kept]
        self.bounds = np.searchsorted(kept, gram_bounds)
        self.row = np.repeat(np.arange(self.rows), np.diff(self.bounds))

    @staticmethod
    def _kept(hashes: np.ndarray, place: np.ndarray, bounds: np.ndarray, window: int) -> np.ndarray:
        """Indexes of the grams that are the least of some window of their text."""
        total = len(hashes)
        keys = (hashes & ~_LOW) | (_LOW - place.astype(U64))
        least = keys
        width = 1
        while 2 * width <= window and len(least) > width:
            least = np.minimum(least[:-width], least[width:])
            width *= 2
        sizes = np.diff(bounds)
        begin = np.arange(total - window + 1) if total >= window else np.zeros(0, np.int64)
        # A window lies within one text if its last gram is in the text of its first.
        begin = begin[place[begin] + window - 1 == place[begin + window - 1]] if len(begin) else begin
        found = [
            np.repeat(bounds[:-1], np.maximum(sizes - window + 1, 0))
            + (_LOW - (np.minimum(least[begin], least[begin + window - width]) & _LOW)).astype(np.int64)
            if len(begin)
            else begin
        ]
        few = np.flatnonzero((sizes > 0) & (sizes < window))
        if len(few):
            # Texts with one window: minima over their ranges.
            edges = np.column_stack((bounds[few], bounds[few + 1])).ravel()
            edges = edges[:-1] if edges[-1] == total else edges
            found.append(bounds[few] + (_LOW - (np.minimum.reduceat(keys, edges)[::2] & _LOW)).astype(np.int64))
        return np.unique(np.concatenate(found))

    def keys(self) -> np.ndarray:
        """Distinct (text, hash) as sorted numbers."""
        return np.unique(mix(self.hashes + self.row.astype(U64) * _ROW))

    def digests(self) -> list[str]:
        """A digest of each text's hashes and positions."""
        pairs = np.column_stack((self.hashes, self.positions.astype(U64))).astype("<u8")
        return [hashlib.sha256(pairs[a:b].tobytes()).hexdigest() for a, b in zip(self.bounds[:-1], self.bounds[1:])]


def likeness(one: Prints, other: Prints, rows: np.ndarray | None = None) -> np.ndarray:
    """Jaccard similarity of each text of `one` with the text of `other` in the same place, or in the place `rows`."""
    rows = np.arange(one.rows) if rows is None else rows
    size = np.zeros((2, one.rows), np.int64)
    sides = []
    for side, (prints, to) in enumerate(((one, np.arange(one.rows)), (other, rows))):
        # The sets of `other` are read through `rows`, as those of the texts of `one`.
        counts = np.diff(prints.bounds)[to]
        ends = np.cumsum(counts)
        at = np.repeat(prints.bounds[to] - ends + counts, counts) + np.arange(ends[-1] if len(ends) else 0)
        label = np.repeat(np.arange(one.rows), counts)
        keys, first = np.unique(mix(prints.hashes[at] + label.astype(U64) * _ROW), return_index=True)
        size[side] = np.bincount(label[first], minlength=one.rows)
        sides.append((keys, label[first]))
    common = np.isin(sides[0][0], sides[1][0], assume_unique=True)
    shared = np.bincount(sides[0][1][common], minlength=one.rows)
    union = size.sum(0) - shared
    return np.where(union > 0, shared / np.maximum(union, 1), 1.0)


def fingerprints(documents: DataFrame, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """doc_id with the hashes and the positions (in code points) of the kept grams, in order of position."""
    ship_package(documents.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, b in slices(rows["text"]):
                prints = Prints(rows["text"].slice(a, b - a), gram, window)
                offsets = pa.array(prints.bounds.astype(np.int32))
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"].slice(a, b - a),
                        pa.ListArray.from_arrays(offsets, pa.array(prints.hashes.view(np.int64))),
                        pa.ListArray.from_arrays(offsets, pa.array(prints.positions.astype(np.int32))),
                    ],
                    ["doc_id", "hashes", "positions"],
                )

    narrow = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(run, f"doc_id long, {PRINTS}")


def edited(text: str, following: str) -> str:
    """The text with its last half replaced by the beginning of another text."""
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def _compared(ids: list, texts: list[str], gram: int, window: int) -> list[list]:
    """Columns of COMPARED for all rows but the last, each with the row after it as the next document."""
    new = [edited(a, b) for a, b in zip(texts, texts[1:])]
    whole = Prints(pa.array(texts, pa.large_string()), gram, window)
    changed = Prints(pa.array(new, pa.large_string()), gram, window)
    n = len(new)
    own = Prints.__new__(Prints)
    own.rows, own.bounds = n, whole.bounds[: n + 1]
    own.hashes, own.positions = whole.hashes[: own.bounds[-1]], whole.positions[: own.bounds[-1]]
    digests = whole.digests()[:n]
    return [
        ids[:n],
        whole.chars[:n].tolist(),
        [hashlib.sha256(t.encode()).hexdigest() for t in new],
        digests,
        changed.digests(),
        likeness(own, changed).tolist(),
        likeness(own, whole, np.arange(1, n + 1)).tolist(),
    ]


_PART_TYPES = [pa.string(), pa.int32(), pa.int64(), pa.int64(), *[pa.string()] * 3, *[pa.float64()] * 2, pa.string()]
_PART_NAMES = [c.split(" ")[0] for c in _PART.split(", ")]


def _part_rows(kind: str, part: int, columns: list[list], texts: list | None = None) -> pa.RecordBatch:
    n = len(columns[0])
    full = [[kind] * n, [part] * n, *columns, *[[None] * n] * (7 - len(columns)), texts or [None] * n]
    return pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(full, _PART_TYPES)], _PART_NAMES)


def _in_order(gram: int, window: int):
    """Rows of one range in order: finished documents, and the first and the last one."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, ids, texts = TaskContext.get().partitionId(), [], []
        first = True
        for rows in batches:
            for a, b in slices(rows["text"]):
                ids += rows["doc_id"].slice(a, b - a).to_pylist()
                texts += [t or "" for t in rows["text"].slice(a, b - a).to_pylist()]
                if first:
                    yield _part_rows("first", part, [ids[:1]], texts[:1])
                    first = False
                if len(ids) > 1:
                    yield _part_rows("done", part, _compared(ids, texts, gram, window))
                    ids, texts = ids[-1:], texts[-1:]
        if ids:
            yield _part_rows("last", part, [ids], texts)

    return run


def _closing(gram: int, window: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names, kinds = _PART_NAMES[2:-1], _PART_TYPES[2:-1]
        for rows in batches:
            for i in range(rows.num_rows):
                row = rows.slice(i, 1).to_pylist()[0]
                columns = _compared([row["doc_id"]] * 2, [row["text"], row["following"]], gram, window)
                yield pa.RecordBatch.from_arrays([pa.array(v, t) for v, t in zip(columns, kinds)], names)

    return run


def compare_next(documents: DataFrame, *, gram: int = GRAM, window: int = WINDOW) -> DataFrame:
    """COMPARED for every document: digests of the fingerprints of its text and of its edited text (its last half
    replaced by the beginning of the next document, by descending doc_id, the first after the last), and how alike its
    fingerprint is to the edited text's and to the next document's."""
    ship_package(documents.sparkSession)
    rows = documents.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    place = [F.col("doc_id").desc_nulls_last(), F.xxhash64("text")]
    dealt = rows.repartitionByRange(*place).sortWithinPartitions(*place)
    parts = stored(dealt.mapInArrow(_in_order(gram, window), _PART), "fingerprints")
    # One row per range from here on.
    edges = parts.where(F.col("kind") == "first").select("part")
    turn = W.orderBy("part")
    following = edges.select(
        "part", F.coalesce(F.lead("part").over(turn), F.first("part").over(turn)).alias("next_part")
    )
    heads = parts.where(F.col("kind") == "first").select(F.col("part").alias("next_part"), F.col("text").alias("following"))
    last = parts.where(F.col("kind") == "last").select("part", "doc_id", "text")
    closing = last.join(following, "part").join(heads, "next_part").select("doc_id", "text", "following")
    done = parts.where(F.col("kind") == "done").select(*_PART_NAMES[2:-1])
    return done.unionByName(closing.mapInArrow(_closing(gram, window), COMPARED))
