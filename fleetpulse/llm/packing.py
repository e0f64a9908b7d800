"""Best-fit packing of tokenized documents into sequences of a fixed capacity, by matching large items.

Documents become token ids and an end id; those longer than the capacity are cut into full pieces and a last one. Only
lengths matter to packing, so it works on how many pieces there are of each length (at most `capacity` numbers, however
many documents): pieces above a third of the capacity meet at most in pairs, each longest one with the longest that
still fits beside it; smaller pieces, longest first, go where the least room is left. The outcome says, for each length,
which runs of ranks go to which runs of sequences; pieces are ranked within their length by hash shard, without sorting a
length in one task, and look their place up.

Null text: empty, so a document of the end id alone. Null doc_id: passed on. Repeated rows: each is packed. Very long
texts are tokenized whole, in runs of words. An empty table gives no pieces. Extra columns are ignored.
"""

from __future__ import annotations

import bisect
import os
import re
import zlib
from array import array
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from fleetpulse.llm.common import ship_package, slices, stored
from fleetpulse.llm.text import Batch

CAPACITY = 4096
END_ID = 1
#: Words whose ids a worker remembers, at most.
REMEMBERED_WORDS = 300_000
#: Words that are encoded at once, at most: what they need on the way stays small.
ENCODED_TOGETHER = 4096
#: Pieces in a hash shard of one length, about.
SHARD_ROWS = 100_000
PIECE = "doc_id long, piece int, start long, length long, ids_crc32 long, ids array<int>"


def _ranges(values: np.ndarray, starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """Ranges of values, one after the other."""
    ends = np.cumsum(sizes, dtype=np.int64)
    return values[np.repeat(starts - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0)]


class Encoder:
    """Token ids of whole texts by a tokenizer file that treats white space as a separator and drops it.

    Such a tokenizer gives a text the ids of its words one after the other, so that each distinct word is encoded once
    and remembered, by the 64-bit hash of its bytes; when there are too many, those that came again stay. A word of plain
    letters, with or without ASCII punctuation after it, goes to the tokenizer's model at once; its normalizer and
    splitter, whose outcome is known for such words, take most of its time. All other words go through the whole
    tokenizer, and texts with one of its special strings are encoded as they are.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.special = [t.content for t in self.tokenizer.get_added_tokens_decoder().values()]
        # How the splitter spells each letter, asked of itself; letters that it does not take in lower case are not plain.
        letters = [chr(c) for c in range(0x250) if chr(c).isalpha() and chr(c).islower()]
        self.spelling = {}
        for c in letters:
            split = self.tokenizer.pre_tokenizer.pre_tokenize_str(c)
            if len(split) == 1 and self.tokenizer.normalizer.normalize_str(c) == c and self._whole(c * 2) == self._model(split[0][0] * 2):
                self.spelling[ord(c)] = split[0][0]
        plain = "".join(map(chr, self.spelling))
        upper = "".join(c.upper() for c in plain if len(c.upper()) == 1 and c.upper().lower() == c and c.upper() != c)
        upper = "".join(c for c in upper if self.tokenizer.normalizer.normalize_str(c) == c.lower())
        # Punctuation that the splitter cuts off a word as one piece, whichever stand together, and spells as it is.
        split = self.tokenizer.pre_tokenizer.pre_tokenize_str
        marks = [c for c in map(chr, range(33, 127)) if not c.isalnum() and self.tokenizer.normalizer.normalize_str(c) == c]
        marks = [c for c in marks if plain and [x for x, _ in split(f"{plain[0]}{c}")] == [self.spelling[ord(plain[0])], c]]
        marks = [c for c in marks if all([x for x, _ in split(pair)] == [pair] for d in marks for pair in (c + d, d + c))]
        tail = f"[{re.escape(''.join(marks))}]*+" if marks else ""
        # A word to a line: letters and the marks after them, or anything else.
        self.plain = re.compile(f"^(?:([{plain}{upper}]++)({tail})|(.*))$" if plain else "^()()(.*)$", re.MULTILINE)
        self._start()

    def _whole(self, text: str) -> list[int]:
        return self.tokenizer.encode(text, add_special_tokens=False).ids

    def _model(self, spelled: str) -> list[int]:
        return [t.id for t in self.tokenizer.model.tokenize(spelled)]

    @staticmethod
    def _packed(ids: list[int]) -> bytes:
        return array("I", ids).tobytes()

    def _start(self) -> None:
        self.hashes, self.places = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.starts, self.lengths = np.zeros(1, np.int64), np.ones(1, np.int32)
        self.pool = np.array([END_ID], np.uint32)  # place 0: the end id
        self.again = np.zeros(1, bool)  # of each place: the word came again
        self.parts: dict[str, bytes] = {"": b""}

    def _forget(self) -> None:
        """Keep the words that came again since they were learnt or last kept, or none if those are most."""
        keep = self.again[self.places]
        if 2 * keep.sum() > REMEMBERED_WORDS:
            return self._start()
        hashes, places = self.hashes[keep], self.places[keep]
        sizes = self.lengths[places]
        ids = _ranges(self.pool, self.starts[places], sizes)
        self._start()
        self._learn(hashes, sizes, ids)

    def _learn(self, hashes: np.ndarray, sizes: np.ndarray, ids: np.ndarray) -> None:
        """Add words, which are not yet known, in order of their hashes."""
        places = (len(self.starts) + np.arange(len(hashes))).astype(np.int32)
        at = np.searchsorted(self.hashes, hashes)
        self.starts = np.concatenate((self.starts, len(self.pool) + np.cumsum(sizes, dtype=np.int64) - sizes))
        self.lengths = np.concatenate((self.lengths, sizes.astype(np.int32)))
        self.pool = np.concatenate((self.pool, ids))
        self.again = np.concatenate((self.again, np.zeros(len(hashes), bool)))
        self.hashes = np.insert(self.hashes, at, hashes)
        self.places = np.insert(self.places, at, places)

    def _encode(self, lines: str) -> list[bytes]:
        """The ids of each word, four bytes each; a word is a line."""
        letters, tails, odd = zip(*self.plain.findall(lines))
        letters = "\n".join(letters).lower().split("\n")
        unknown = [w for w in dict.fromkeys(letters) if w not in self.parts]
        for w, spelled in zip(unknown, "\n".join(unknown).translate(self.spelling).split("\n")):
            self.parts[w] = self._packed(self._model(spelled))
        for w in set(tails):
            if w not in self.parts:
                self.parts[w] = self._packed(self._whole(w))
        parts = self.parts
        out = [parts[w] + parts[tail] if tail else parts[w] for w, tail in zip(letters, tails)]
        others = [i for i, w in enumerate(odd) if w]
        for i, found in zip(others, self.tokenizer.encode_batch_fast([odd[i] for i in others], add_special_tokens=False)):
            out[i] = self._packed(found.ids)
        return out

    def _known(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where hashes are, or would be, among the remembered ones, and whether they are."""
        at = np.searchsorted(self.hashes, hashes)
        there = np.zeros(len(hashes), bool)
        inside = at < len(self.hashes)
        there[inside] = self.hashes[at[inside]] == hashes[inside]
        return at, there

    def _places(self, batch: Batch) -> np.ndarray:
        """Where the ids of each word of the batch are, after words not yet known have been encoded."""
        distinct, first, inverse = np.unique(batch.word_hashes(), return_index=True, return_inverse=True)
        at, there = self._known(distinct)
        self.again[self.places[at[there]]] = True
        if len(self.hashes) and len(self.hashes) + (~there).sum() > REMEMBERED_WORDS:
            self._forget()
            at, there = self._known(distinct)
        new = np.flatnonzero(~there)
        if len(new):
            data = np.append(batch.data, np.uint8(10))
            sizes, ids = [], []
            for some in np.array_split(first[new], -(-len(new) // ENCODED_TOGETHER)):
                spans = batch.ends[some] - batch.starts[some] + 1
                lines = _ranges(data, batch.starts[some], spans)  # each word and the byte after it
                lines[np.cumsum(spans) - 1] = 10
                found = self._encode(lines[:-1].tobytes().decode("utf-8"))
                sizes.append(np.fromiter(map(len, found), np.int64, len(found)) // 4)
                ids.append(np.frombuffer(b"".join(found), np.uint32))
            self._learn(distinct[new], np.concatenate(sizes), np.concatenate(ids))
            at = np.searchsorted(self.hashes, distinct)
        return self.places[at][inverse]

    def texts(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, each with the end id after it, and the bounds of each text among them."""
        batch = Batch(texts)
        data = batch.data.tobytes()
        places = self._places(batch)
        places = np.insert(places, batch.word_bounds[1:], 0)
        bounds = batch.word_bounds + np.arange(batch.rows + 1)
        sizes = self.lengths[places].astype(np.int64)
        ids = _ranges(self.pool, self.starts[places], sizes)
        bounds = np.concatenate(([0], np.cumsum(sizes)))[bounds]
        if any(s.encode() in data for s in self.special):
            each = [
                np.array([*self._whole(t), END_ID], np.uint32) if any(s in t for s in self.special) else ids[bounds[i] : bounds[i + 1]]
                for i, t in enumerate(t or "" for t in texts.to_pylist())
            ]
            bounds = np.cumsum([0, *map(len, each)])
            ids = np.concatenate(each)
        return ids, bounds


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of this Python worker, which later tasks use again with what it remembers."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def _tokenizing(path: str, capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in batches:
            for a, b in slices(rows["text"]):
                ids, bounds = encoder(path).texts(rows["text"].slice(a, b - a))
                counts = -(-np.diff(bounds) // capacity)
                row = np.repeat(np.arange(b - a), counts)
                piece = np.arange(len(row)) - np.repeat(np.cumsum(counts) - counts, counts)
                first = bounds[row] + piece * capacity
                last = np.minimum(first + capacity, bounds[row + 1])
                raw = ids.astype("<u4").view(np.uint8)
                crcs = [zlib.crc32(raw[4 * x : 4 * y]) for x, y in zip(first.tolist(), last.tolist())]
                offsets = np.concatenate((first, bounds[-1:])).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        rows["doc_id"].slice(a, b - a).take(pa.array(row)),
                        pa.array(piece.astype(np.int32)),
                        pa.array(piece * capacity),
                        pa.array(last - first),
                        pa.array(crcs, pa.int64()),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids.view(np.int32))),
                    ],
                    ["doc_id", "piece", "start", "length", "ids_crc32", "ids"],
                )

    return run


def pieces(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """The pieces of each document: doc_id, piece, start, length, ids_crc32 and the ids."""
    ship_package(documents.sparkSession)
    narrow = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return narrow.mapInArrow(_tokenizing(tokenizer, capacity), PIECE)


class _Bins:
    """Runs of equal sequences by the room they have left."""

    def __init__(self, capacity: int):
        self.capacity, self.opened = capacity, 0
        self.runs: dict[int, list[tuple[int, int]]] = {}  # room -> runs (first sequence, number of sequences)
        self.rooms: list[int] = []  # rooms that have runs, ascending
        self.placed: dict[int, list[tuple[int, int, int]]] = {}  # length -> runs (first sequence, number, offset)

    def add(self, room: int, first: int, number: int) -> None:
        if room and number:
            if room not in self.runs:
                self.runs[room] = []
                bisect.insort(self.rooms, room)
            self.runs[room].append((first, number))

    def take(self, room: int, number: int) -> tuple[int, int]:
        """Up to so many sequences with this room, as one run."""
        first, there = self.runs[room].pop()
        used = min(there, number)
        if used < there:
            self.runs[room].append((first + used, there - used))
        if not self.runs[room]:
            del self.runs[room]
            self.rooms.pop(bisect.bisect_left(self.rooms, room))
        return first, used

    def put(self, length: int, first: int, number: int, offset: int) -> None:
        self.placed.setdefault(length, []).append((first, number, offset))

    def open(self, number: int) -> int:
        self.opened += number
        return self.opened - number


def assign(counts: dict[int, int], capacity: int = CAPACITY) -> dict[int, list[tuple[int, int, int]]]:
    """For each length, runs (first sequence, number of sequences, offset) that together hold all its pieces, one piece
    to a sequence in each run."""
    bins = _Bins(capacity)
    large = {n: c for n, c in counts.items() if 3 * n > capacity and c}
    lengths = sorted(large)
    # Greedy matching: each longest piece with the longest left that fits beside it.
    while lengths:
        n = lengths[-1]
        i = bisect.bisect_right(lengths, capacity - n) - 1
        if i < 0:
            number = large[n]
            first = bins.open(number)
            bins.put(n, first, number, 0)
            bins.add(capacity - n, first, number)
            used = {n: number}
        else:
            m = lengths[i]
            number = min(large[n], large[m]) if m != n else large[n] // 2
            if not number:  # one piece left, and no other fits beside it but itself
                lengths_left = lengths[:i]
                m = lengths_left[-1] if lengths_left else None
                number = 1
            first = bins.open(number)
            bins.put(n, first, number, 0)
            if m is not None:
                bins.put(m, first, number, n)
            bins.add(capacity - n - (m or 0), first, number)
            used = {n: number}
            if m is not None:
                used[m] = used.get(m, 0) + number
        for k, c in used.items():
            large[k] -= c
            if not large[k]:
                lengths.remove(k)
    for n in sorted((n for n, c in counts.items() if 3 * n <= capacity and c), reverse=True):
        rest = counts[n]
        while rest:
            i = bisect.bisect_left(bins.rooms, n)
            if i == len(bins.rooms):
                # Best fit fills one new sequence after the other.
                each = capacity // n
                whole, last = divmod(rest, each)
                if whole:
                    first = bins.open(whole)
                    for k in range(each):
                        bins.put(n, first, whole, k * n)
                    bins.add(capacity - each * n, first, whole)
                if last:
                    first = bins.open(1)
                    for k in range(last):
                        bins.put(n, first, 1, k * n)
                    bins.add(capacity - last * n, first, 1)
                rest = 0
            else:
                room = bins.rooms[i]
                first, number = bins.take(room, rest)
                # The room shrinks below n or stays the least that fits: the same sequences are filled on.
                while number and room >= n:
                    use = min(number, rest)
                    if use < number:
                        bins.add(room, first + use, number - use)
                        number = use
                    bins.put(n, first, use, capacity - room)
                    rest -= use
                    room -= n
                    if not rest:
                        break
                bins.add(room, first, number)
    return bins.placed


def pack(rows: DataFrame, capacity: int = CAPACITY) -> DataFrame:
    """The pieces (doc_id, piece, length and any other columns), each with sequence_id and offset.

    Reads the rows twice: give it a written table.
    """
    spark = rows.sparkSession
    ship_package(spark)
    names = rows.columns
    counts = {r["length"]: r["n"] for r in rows.groupBy("length").agg(F.count("*").alias("n")).collect()}
    shards = max(1, -(-max(counts.values(), default=1) // SHARD_ROWS))
    rank = Window.partitionBy("length", "_shard").orderBy("doc_id", "piece", "start")
    base = Window.partitionBy("length").orderBy("_shard").rowsBetween(Window.unboundedPreceding, -1)
    placed = rows.withColumn("_shard", F.pmod(F.xxhash64("doc_id", "piece", "start"), F.lit(shards)))
    sums = placed.groupBy("length", "_shard").agg(F.count("*").alias("_n"))
    bases = sums.select("length", "_shard", F.coalesce(F.sum("_n").over(base), F.lit(0)).alias("_base"))
    ranked = (
        placed.withColumn("_local", F.row_number().over(rank) - 1)
        .join(bases, ["length", "_shard"])
        .withColumn("_rank", F.col("_local") + F.col("_base"))
    )
    runs = spark.sparkContext.broadcast(_lookup(assign(counts, capacity)))
    find = F.pandas_udf(lambda length, rank: _find(runs.value, length, rank), "sequence_id long, offset long")
    return ranked.withColumn("_place", find("length", "_rank")).select(*names, "_place.sequence_id", "_place.offset")


def _lookup(placed: dict[int, list[tuple[int, int, int]]]) -> dict[int, tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each length the first rank, first sequence and offset of each run."""
    out = {}
    for length, runs in placed.items():
        first, number, offset = np.array(runs, np.int64).T
        out[length] = (np.cumsum(number) - number, first, offset)
    return out


def _find(runs, length, rank):
    import pandas as pd

    length, rank = length.to_numpy(), rank.to_numpy()
    sequence, offset = np.empty(len(rank), np.int64), np.empty(len(rank), np.int64)
    order = np.argsort(length, kind="stable")
    bounds = np.flatnonzero(np.concatenate(([True], np.diff(length[order]) != 0, [True])))
    for low, high in zip(bounds[:-1], bounds[1:]):
        at = order[low:high]
        starts, first, offsets = runs[int(length[at[0]])]
        run = np.searchsorted(starts, rank[at], side="right") - 1
        sequence[at] = first[run] + rank[at] - starts[run]
        offset[at] = offsets[run]
    return pd.DataFrame({"sequence_id": sequence, "offset": offset})


def pack_documents(documents: DataFrame, tokenizer: str, capacity: int = CAPACITY) -> DataFrame:
    """Tokenize, cut and pack: one row per piece with its ids and its place."""
    return pack(stored(pieces(documents, tokenizer, capacity), "pieces"), capacity)


def word_tokenizer() -> str:
    """The public word tokenizer that the queries use."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")
