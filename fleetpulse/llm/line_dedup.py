"""Line dedup by pairwise alignment: what a document shares with an earlier one, in aligned blocks, is deleted from it.

A line is known by its runs: from each line on, and up to each line, the shortest run of lines that has `min_block_words`
words. A run is known by the hash of its lines and its number among equal runs of the document; the lines around it do
not matter, so that lines of any length count. Any block of that many words which two documents share is made up of such
runs. The first document that has a run, by id, holds it. Each document is paired with the holders of its runs, so that
the pairs grow with the lines (two runs for each at most) and not with the square of a group, and every shared block is
shown whole, each run of it by its own holder. A pair's common runs are aligned by patience: their longest increasing
sequence is kept, and runs that meet in both documents are one block. What is left is aligned again, so that moved
blocks go too. The blocks are deleted from the later document, with the blank lines in them and between neighbouring
ones; blank lines do not break a block. The holder keeps its lines, so that one copy of everything stays.

Null or empty text: no lines, left as it is. Null doc_id: before all others. Equal ids: in order of the text's hash; rows
that agree in both id and text are one document and get the same result. Very long texts are split as any other. Extra
columns are passed on. An empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect_left
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import WORD, row_key, ship_package, stored
from fleetpulse.llm.text import occurrence, range_hashes

MIN_BLOCK_WORDS = 20


def _lines(documents: DataFrame) -> DataFrame:
    """Per document its key and its lines that have words: place among all lines, hash and number of words."""
    parts = F.split(F.coalesce(F.col("text"), F.lit("")), "\n", -1)
    rows = documents.select(
        row_key().alias("_key"),
        F.transform(
            parts,
            lambda line, i: F.struct(
                i.alias("line"), F.xxhash64(line).alias("h"), F.regexp_count(line, F.lit(WORD)).alias("words")
            ),
        ).alias("_lines"),
    ).select("_key", F.filter("_lines", lambda x: x["words"] > 0).alias("_lines"))
    return rows.where(F.size("_lines") > 0)


def shortest_runs(words: np.ndarray, bounds: np.ndarray, min_words: int) -> tuple[np.ndarray, np.ndarray]:
    """First and last line of the shortest runs of enough words that begin or end at a line and stay in its document."""
    total = np.concatenate(([0], np.cumsum(words, dtype=np.int64)))
    at, size = np.arange(len(words)), np.diff(bounds)
    begin, end = np.repeat(bounds[:-1], size), np.repeat(bounds[1:], size)
    last = np.searchsorted(total, total[:-1] + min_words) - 1
    first = np.searchsorted(total, total[1:] - min_words, side="right") - 1
    onward, back = last < end, first >= begin
    runs = np.unique(np.concatenate((at[onward] * len(words) + last[onward], first[back] * len(words) + at[back])))
    return runs // max(len(words), 1), runs % max(len(words), 1)


def _known(min_words: int):
    """Per document: the runs of its lines, where they lie and what they are known by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            d, h = (rows["_key"].field(name).to_numpy(zero_copy_only=False) for name in "dh")
            bounds = rows["_lines"].offsets.to_numpy().astype(np.int64)
            bounds -= bounds[0]
            lines = rows["_lines"].flatten()
            line, own, words = (lines.field(name).to_numpy(zero_copy_only=False) for name in ("line", "h", "words"))
            first, last = shortest_runs(words, bounds, min_words)
            row = np.searchsorted(bounds, first, side="right") - 1
            known = range_hashes(own, first, last + 1)
            n = occurrence(known, row)
            rank = first - bounds[row]
            columns = [d[row], h[row], line[first], line[last], rank, last - first + 1, known.view(np.int64), n]
            out = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, _TYPES)], _NAMES)
            for start in range(0, max(out.num_rows, 1), 50_000):
                yield out.slice(start, 50_000)

    return run


_KNOWN = "d long, h long, line int, last_line int, rank int, size int, run long, n int"
_TYPES = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int32()]
_NAMES = ["d", "h", "line", "last_line", "rank", "size", "run", "n"]


def increasing(values: list[int]) -> list[int]:
    """Indices of a longest strictly increasing sequence, by patience sorting."""
    tops, piles, back = [], [], [-1] * len(values)
    for i, v in enumerate(values):
        p = bisect_left(tops, v)
        back[i] = piles[p - 1] if p else -1
        if p == len(tops):
            tops.append(v)
            piles.append(i)
        else:
            tops[p], piles[p] = v, i
    out, at = [], piles[-1] if piles else -1
    while at >= 0:
        out.append(at)
        at = back[at]
    return out[::-1]


def common_blocks(matches: list[tuple[int, int, int]]) -> list[tuple[int, int]]:
    """Blocks (first and last rank in the later document) from (rank, rank in the earlier document, lines) of the common
    runs."""
    left, blocks = sorted(set(matches), key=lambda m: (m[0], -m[1], m[2])), []
    while left:
        chosen = increasing([m[1] for m in left])
        first, held, last = left[chosen[0]][0], left[chosen[0]][1], left[chosen[0]][0] - 1
        for rank, held_rank, size in (left[i] for i in chosen):
            if rank > last + 1 or held_rank - rank != held - first:
                blocks.append((first, last))
                first, held, last = rank, held_rank, rank - 1
            last = max(last, rank + size - 1)
        blocks.append((first, last))
        taken = set(chosen)
        left = [m for i, m in enumerate(left) if i not in taken]
    return blocks


def _aligning(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        deleted = []
        for matches in rows["matches"].to_pylist():
            pairs: dict[tuple, list] = {}
            line_of: dict[int, int] = {}
            for m in matches:
                pairs.setdefault((m["hd"], m["hh"]), []).append((m["rank"], m["held_rank"], m["size"]))
                line_of[m["rank"]] = m["line"]
                line_of[m["rank"] + m["size"] - 1] = m["last_line"]
            spans: list[list[int]] = []
            # Blocks that overlap or are neighbours, of whatever pair, go as one.
            for x, y in sorted(block for pair in pairs.values() for block in common_blocks(pair)):
                if spans and x <= spans[-1][1] + 1:
                    spans[-1][1] = max(spans[-1][1], y)
                else:
                    spans.append([x, y])
            deleted.append([[line_of[x], line_of[y]] for x, y in spans])
        yield pa.RecordBatch.from_arrays(
            [rows["d"], rows["h"], pa.array(deleted, pa.list_(pa.list_(pa.int32())))], ["d", "h", "spans"]
        )


def deletions(documents: DataFrame, min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """For each document that loses lines its key and the spans (first and last line) to delete."""
    ship_package(documents.sparkSession)
    runs = stored(_lines(documents).mapInArrow(_known(min_block_words), _KNOWN), "runs")
    identity = ["run", "n"]
    held = (
        runs.groupBy(*identity)
        .agg(F.min(F.struct("d", "h", "rank")).alias("first"), F.max(F.struct("d", "h")).alias("last"))
        .where("first.d < last.d or first.h < last.h")
        .select(*identity, F.col("first.d").alias("hd"), F.col("first.h").alias("hh"), F.col("first.rank").alias("held_rank"))
    )
    matches = runs.join(held, identity).where("d <> hd or h <> hh")
    # A document's own matches lie on one row: at most twice as many as it has lines.
    each = matches.groupBy("d", "h").agg(
        F.collect_set(F.struct("line", "last_line", "rank", "size", "hd", "hh", "held_rank")).alias("matches")
    )
    return each.mapInArrow(_aligning, "d long, h long, spans array<array<int>>")


def dedup_lines(documents: DataFrame, min_block_words: int = MIN_BLOCK_WORDS) -> DataFrame:
    """The documents with all their columns, the text without the deleted blocks, and deleted_lines (their number)."""
    spans = stored(deletions(documents, min_block_words), "deletions")
    spans = spans.select(F.struct("d", "h").alias("_key"), F.col("spans").alias("_spans"))
    rows = documents.select(F.struct("*").alias("_whole"), F.col("text").alias("_text"), row_key().alias("_key"))
    gone = F.array_distinct(F.flatten(F.transform("_spans", lambda s: F.sequence(s[0], s[1]))))
    kept = F.filter(F.split("_text", "\n", -1), lambda _, i: ~F.array_contains(F.col("_gone"), i))
    left = F.when(F.col("_gone").isNull(), F.col("_text")).otherwise(F.array_join(kept, "\n"))
    names = [c for c in documents.columns if c.lower() != "deleted_lines"]
    return (
        # The spans grow with the documents: the same join at every size, and no broadcast.
        rows.join(spans.hint("merge"), "_key", "left")
        .withColumn("_gone", F.when(F.col("_spans").isNotNull(), gone))
        .select(
            *[left.alias(c) if c == "text" else F.col("_whole")[c].alias(c) for c in names],
            F.when(F.col("_gone").isNull(), 0).otherwise(F.size("_gone")).alias("deleted_lines"),
        )
    )
