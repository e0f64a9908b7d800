"""Exact top-k search by BM25: an inverted index in shards, pruned by block maxima, merged with global statistics.

Terms are words in lower case, cut at ASCII punctuation, known by 64-bit hashes; a query is the set of its terms. Each
task indexes the documents it reads in shards of bounded size: for each term the documents and its frequency in them.
Term counts over all shards, the number of documents and their mean length are global, so that a score does not depend
on the shard.

A shard answers a block of queries as follows. Its documents lie in blocks. Terms in few of its documents are added up over
their postings, which lie in chunks of one size, so that a query's are copied and added whole. Terms in many of them are
columns of a matrix and have, for each block, the most that they add to any document in it; with what the rare terms add
there, that bounds the block for a query. Groups of blocks are read in order of falling bounds, and only for the queries
whose bound for them reaches their k-th best score so far, which rises from group to group; it begins with the documents
that have the most from rare terms, or with the k-th best of the shards that the task has answered before. The matrix is
multiplied in single precision, with room for its error; documents that may be among the best are scored again in double
precision, by sums that do not depend on their order, so that copies in other shards get the same score. Every task returns the k best of its shards, and the best k of all tasks are the result; tasks are as many as
the cores ask for, not as the shards are. Scores are rounded to nine decimals, ties go to the smaller id. This is the pruning of block-max WAND by block
instead of by document: there is no pivot, as the queries of a batch share the order in which they read.

Queries are sent to the executors in blocks of bounded size (BLOCK_TERMS terms, or a single longer query, and BLOCK_QUERIES
queries, as a worker holds the best of each), once for each worker, one job for each block; shards stay where they are read, and are read once for each block. A worker holds one
shard, one block and the scores of TOGETHER queries.

The work of all queries is queries times documents, less what is skipped: where queries grow with the documents it grows
with their product, in time, not in memory. Very long texts: indexed whole, and asked whole. Null or empty text: a document that no query finds, a
query that finds nothing. Null doc_id: a document like any other, before all others among ties; never a query. Repeated
rows: each is a document, and one query. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import Broadcast, TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import BATCH_ROWS, ship_package, slices, stored
from fleetpulse.llm.text import FOLD, U64, Batch, mix
from fleetpulse.session import shared_dir

K = 10
K1, B = 1.2, 0.75
SHARD_DOCS = 8192
SHARD_POSTINGS = 3_000_000
BLOCK_DOCS = 64
BLOCKS_TOGETHER = 8
#: Terms in more than one of so many documents of a shard are dense and have block maxima.
COMMON = 16
#: Postings to a chunk; terms with less than half of one are looked up by posting.
CHUNK = 16
#: Terms of all queries of a block, about; a longer query is a block of its own or shares one.
BLOCK_TERMS = 4_000_000
#: Queries of a block, about.
BLOCK_QUERIES = 32_768
#: Queries whose scores a task holds at once.
TOGETHER = 256
#: Terms of these queries, about.
TERMS_TOGETHER = 65_536
#: Tasks that answer a block, if there are no more cores: each returns k documents for a query, however many its shards.
TASKS = 256
#: What a term adds to a score is a multiple of 1 / GRID, 1e-12 about: sums up to 8192 are exact, in whatever order.
GRID = 2.0**40
_NO_ID = -(2**63)
_ROW = U64(0xD6E8FEB86659FD93)
SHARD = "shard string, ids array<long>, lengths array<int>, terms array<long>, counts array<int>, docs binary, freqs binary"
ANSWER = "query_id long, hits array<struct<minus:double,doc:bigint>>"


def term_batch(texts: pa.Array) -> Batch:
    plain = Batch(pc.utf8_lower(texts.cast(pa.large_string())))
    return Batch.of(FOLD[plain.data], plain.doc_bounds)


def term_counts(batch: Batch) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Text, term and frequency of each distinct term of each text, in order of text."""
    hashes, rows = batch.word_hashes(), batch.word_row
    _, first, counts = np.unique(mix(hashes + rows.astype(U64) * _ROW), return_index=True, return_counts=True)
    order = np.argsort(rows[first], kind="stable")
    return rows[first][order], hashes[first][order].view(np.int64), counts[order]


def _lists(values: np.ndarray, kind: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array([0, len(values)], pa.int32()), pa.array(values, kind))


def _packed(values: np.ndarray) -> pa.Array:
    """Numbers from zero in the fewest bytes that all of them fit in: Spark passes them on without looking at each."""
    return pa.array([values.astype(np.min_scalar_type(values.max(initial=0))).tobytes()], pa.binary())


def _unpacked(value: pa.Scalar, number: int) -> np.ndarray:
    held = value.as_buffer()
    return np.frombuffer(held, f"u{held.size // number}" if number else "u1")


def _indexing(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    task = TaskContext.get().partitionId()
    number, parts, ids, lengths, postings = 0, [], [], [], 0

    def shard() -> pa.RecordBatch:
        docs, terms, freqs = (np.concatenate(x) for x in zip(*parts))
        order = np.argsort(terms, kind="stable")
        distinct, counts = np.unique(terms, return_counts=True)
        return pa.RecordBatch.from_arrays(
            [
                pa.array([f"{task}-{number}"]),
                _lists(np.concatenate(ids), pa.int64()),
                _lists(np.concatenate(lengths).astype(np.int32), pa.int32()),
                _lists(distinct, pa.int64()),
                _lists(counts.astype(np.int32), pa.int32()),
                _packed(docs[order]),
                _packed(freqs[order]),
            ],
            ["shard", "ids", "lengths", "terms", "counts", "docs", "freqs"],
        )

    for rows in batches:
        for a, b in slices(rows["text"]):
            batch = term_batch(rows["text"].slice(a, b - a))
            docs, terms, freqs = term_counts(batch)
            parts.append((docs + sum(map(len, ids)), terms, freqs))
            ids.append(rows["doc_id"].slice(a, b - a).fill_null(_NO_ID).to_numpy())
            lengths.append(np.diff(batch.word_bounds))
            postings += len(docs)
            if postings >= SHARD_POSTINGS or sum(map(len, ids)) >= SHARD_DOCS:
                yield shard()
                number, parts, ids, lengths, postings = number + 1, [], [], [], 0
    if ids:
        yield shard()


def index(documents: DataFrame) -> DataFrame:
    """The shards, written: one row for each."""
    ship_package(documents.sparkSession)
    narrow = documents.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return stored(narrow.mapInArrow(_indexing, SHARD), "index")


def _asking(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for a, b in slices(rows["text"]):
            batch = term_batch(rows["text"].slice(a, b - a))
            docs, terms, _ = term_counts(batch)
            offsets = np.searchsorted(docs, np.arange(b - a + 1)).astype(np.int32)
            lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(terms))
            yield pa.RecordBatch.from_arrays([rows["query_id"].slice(a, b - a), lists], ["query_id", "terms"])


def _impact(freqs: np.ndarray, norm: np.ndarray) -> np.ndarray:
    freqs = freqs.astype(float)
    return freqs * (K1 + 1) / (freqs + norm)


def _whole(added: np.ndarray) -> np.ndarray:
    return np.rint(added * GRID) / GRID


def _spread(bounds: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The items of each of the given ranges, one range after the other, and their numbers."""
    sizes = bounds[at + 1] - bounds[at]
    ends = np.cumsum(sizes)
    return np.repeat(bounds[at] - ends + sizes, sizes) + np.arange(ends[-1] if len(ends) else 0), sizes


class Shard:
    """A shard's postings, and scores for a block of queries. weights: of terms, the same for all queries, if they are."""

    def __init__(self, row: dict[str, np.ndarray], mean_length: float, weights: tuple[np.ndarray, np.ndarray] | None = None):
        self.terms, self.n, counts = row["terms"], len(row["ids"]), row["counts"]
        norm = K1 * (1 - B + B * row["lengths"] / max(mean_length, 1e-9))
        term = np.repeat(np.arange(len(self.terms), dtype=np.int32), counts)
        common = counts * COMMON > self.n
        #: Place of a term among the dense ones, or -1.
        self.column = np.where(common, np.cumsum(common) - 1, -1)
        dense = common[term]
        docs, freqs, columns = row["docs"][dense], row["freqs"][dense], self.column[term[dense]]
        self.dense = np.zeros((self.n, common.sum()), np.float32)
        self.dense[docs, columns] = _impact(freqs, norm[docs])
        # Documents alike in their common terms share blocks: order by the main direction of those terms.
        along = np.ones(self.dense.shape[1], np.float32)
        along[: len(along) // 2] = -1
        mean = self.dense.mean(0) if self.n else along
        for _ in range(4):
            projected = self.dense @ along - mean @ along
            along = projected @ self.dense - projected.sum() * mean
            along /= np.linalg.norm(along) + 1e-12
        order = np.argsort(self.dense @ along, kind="stable")
        place = np.empty(self.n, np.int64)
        place[order] = np.arange(self.n)
        self.ids, self.norm, self.dense = row["ids"][order], norm[order], self.dense[order]
        #: Frequencies of the dense terms, for scores in double precision.
        self.freqs = np.zeros(self.dense.shape, np.min_scalar_type(freqs.max(initial=0)))
        self.freqs[place[docs], columns] = freqs
        #: More than a score in single precision is off, as a share of it.
        self.slack = (len(along) + 4) * 2.0**-23
        self.starts = np.arange(0, self.n, BLOCK_DOCS)
        self.most = np.maximum.reduceat(self.dense, self.starts) if self.n else self.dense
        #: Documents, over all queries, whose common terms were added up, and those that were skipped.
        self.read = self.skipped = 0
        # The other postings: in chunks of one size, the last of a term filled up with nothing; or, of the rarest terms, singly.
        docs, term, counts = place[row["docs"][~dense]], term[~dense], np.where(common, 0, counts)
        impact = _impact(row["freqs"][~dense], self.norm[docs])
        self.weights = None
        if weights is not None:
            self.weights = np.zeros(len(self.terms))
            at = self._places(weights[0])
            self.weights[at[at >= 0]] = weights[1][at >= 0]
            impact = _whole(impact * self.weights[term])
        few = counts < CHUNK // 2
        #: Of each term, whether its postings are single, in chunks or dense.
        self.kind = np.where(common, 2, np.where(few, 0, 1)).astype(np.int8)
        single = few[term]
        self.single = np.concatenate(([0], np.cumsum(np.where(few, counts, 0), dtype=np.int64)))
        self.single_docs, self.single_impact = docs[single], impact[single]
        self.chunk = np.concatenate(([0], np.cumsum(np.where(few, 0, -(-counts // CHUNK)), dtype=np.int64)))
        place = (self.chunk[:-1] * CHUNK - np.cumsum(counts) + counts)[term] + np.arange(len(term))
        self.chunk_docs, self.chunk_impact = np.zeros((self.chunk[-1], CHUNK), np.int64), np.zeros((self.chunk[-1], CHUNK))
        self.chunk_docs.ravel()[place[~single]], self.chunk_impact.ravel()[place[~single]] = docs[~single], impact[~single]

    def _places(self, terms: np.ndarray) -> np.ndarray:
        """Place of each term among those of the shard, or -1."""
        if not len(self.terms):
            return np.full(len(terms), -1)
        at = np.minimum(np.searchsorted(self.terms, terms), len(self.terms) - 1)
        return np.where(self.terms[at] == terms, at, -1)

    def best(
        self, terms: np.ndarray, weights: np.ndarray | None, bounds: np.ndarray, k: int, which: np.ndarray | None = None,
        least: np.ndarray | None = None,
    ) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """For each query (its range of terms) the scores and ids of its k best documents.

        weights: of the terms of each query, or None for those of the shard. which: the terms of the queries as places in
        `terms`. least: for each query a score that k documents elsewhere reach, or -1; documents below it may be left out.
        """
        at = self._places(terms)
        which = np.arange(len(terms)) if which is None else which
        least = np.full(len(bounds) - 1, -1.0) if least is None else least
        first = 0
        while first < len(bounds) - 1:
            last = min(first + TOGETHER, int(np.searchsorted(bounds, bounds[first] + TERMS_TOGETHER, "right")) - 1, len(bounds) - 1)
            last = max(last, first + 1)
            limits = bounds[first : last + 1]
            held = at[which[limits[0] : limits[-1]]]
            there = held >= 0
            query, held = np.repeat(np.arange(last - first), np.diff(limits))[there], held[there]
            weight = None if weights is None else weights[limits[0] : limits[-1]][there]
            yield from self._some(query, last - first, held, weight, k, least[first:last])
            first = last

    def _rare(self, number: int, query: np.ndarray, at: np.ndarray, weight: np.ndarray | None) -> np.ndarray:
        """What the terms that are not dense add to each document for each query."""
        scores, kind = np.zeros((number, self.n)), self.kind[at]
        some = np.flatnonzero(kind == 1)
        chunks, sizes = _spread(self.chunk, at[some])
        times = None if weight is None else np.repeat(weight[some], sizes)[:, None]
        limits = np.concatenate(([0], np.cumsum(sizes)))[np.searchsorted(query[some], np.arange(number + 1))]
        for q, (low, high) in enumerate(zip(limits[:-1], limits[1:])):
            added = self.chunk_impact.take(chunks[low:high], axis=0)
            if times is not None:
                added = _whole(added * times[low:high])
            np.add.at(scores[q], self.chunk_docs.take(chunks[low:high], axis=0).ravel(), added.ravel())
        some = np.flatnonzero(kind == 0)
        postings, sizes = _spread(self.single, at[some])
        added = self.single_impact[postings]
        if weight is not None:
            added = _whole(added * np.repeat(weight[some], sizes))
        np.add.at(scores.ravel(), np.repeat(query[some] * self.n, sizes) + self.single_docs[postings], added)
        return scores

    def _exact(self, rare: np.ndarray, common: np.ndarray, row: np.ndarray, doc: np.ndarray) -> np.ndarray:
        """Scores, in double precision, of pairs of a query and a document."""
        score = rare[row, doc]
        for low in range(0, len(row), TOGETHER):
            part = slice(low, low + TOGETHER)
            score[part] += _whole(_impact(self.freqs[doc[part]], self.norm[doc[part], None]) * common[row[part]]).sum(1)
        return score

    def _some(self, query, number, at, weight, k, given) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        rare = self._rare(number, query, at, weight)
        often = np.flatnonzero(self.kind[at] == 2)
        common = np.zeros((number, self.dense.shape[1]))
        common[query[often], self.column[at[often]]] = self.weights[at[often]] if weight is None else weight[often]
        single = common.astype(np.float32)
        # What a document of each block can reach at most, and a k-th best score to begin with: that of the k documents with
        # the most from rare terms. Scores in single precision only tell which documents may be among the best.
        reach = np.maximum.reduceat(rare, self.starts, axis=1) + single @ self.most.T
        least = given.copy()
        new = np.flatnonzero(least < 0)
        if self.n > k and len(new):
            top = np.argpartition(-rare[new], k, axis=1)[:, :k]
            least[new] = self._exact(rare, common, np.repeat(new, k), top.ravel()).reshape(-1, k).min(1)
        groups = np.arange(0, len(self.starts), BLOCKS_TOGETHER)
        bound = np.maximum.reduceat(reach, groups, axis=1) * (1 + self.slack)
        best = np.full((number, k), -1.0)  # of the groups read so far
        rows, docs, scores = [], [], []
        for g in np.argsort(-bound.sum(0), kind="stable"):
            start, end = groups[g] * BLOCK_DOCS, min((groups[g] + BLOCKS_TOGETHER) * BLOCK_DOCS, self.n)
            some = np.flatnonzero(bound[:, g] >= least - 1e-7)
            self.read += len(some) * (end - start)
            self.skipped += (number - len(some)) * (end - start)
            if not len(some):
                continue
            total = single[some] @ self.dense[start:end].T + rare[some, start:end]
            highest = total.max(1)
            up = np.flatnonzero(highest >= least[some])
            seen = np.concatenate((best[some[up]], total[up]), axis=1)
            best[some[up]] = seen = np.partition(seen, seen.shape[1] - k, axis=1)[:, -k:]
            least[some[up]] = np.maximum(least[some[up]], seen.min(1) * (1 - self.slack))
            enough = np.maximum(least[some] * (1 - self.slack) - 1e-7, np.finfo(float).tiny)
            has = np.flatnonzero(highest >= enough)
            row, doc = np.nonzero(total[has] >= enough[has, None])
            rows.append(some[has[row]])
            docs.append(start + doc)
            scores.append(total[has[row], doc])
        if not rows:
            rows = docs = scores = [np.zeros(0, np.int64)]
        row, doc, score = np.concatenate(rows), np.concatenate(docs), np.concatenate(scores)
        # What is left out is below the k-th best; what was skipped, too.
        keep = score >= least[row] * (1 - self.slack) - 1e-7
        row, doc = row[keep], doc[keep]
        score = self._exact(rare, common, row, doc)
        keep = score >= given[row] - 1e-7
        row, ids, score = row[keep], self.ids[doc[keep]], np.round(score[keep], 9)
        order = np.lexsort((ids, -score, row))
        row, ids, score = row[order], ids[order], score[order]
        limits = np.searchsorted(row, np.arange(number + 1))
        for low, high in zip(limits[:-1], limits[1:]):
            found = score[low : min(high, low + k)]
            found = found[found > 0]
            yield found, ids[low : low + len(found)]


def _answering(block: Broadcast, mean_length: float, k: int):
    """The k best of a task's shards for each query of a block: query ids, the bounds of their terms, all distinct terms,
    which of these the queries have, and the weights of the distinct terms."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hit = pa.struct([("minus", pa.float64()), ("doc", pa.int64())])
        ids, bounds, terms, which, weights = block.value
        # The best of the shards so far, and those of the shard that is read.
        scores, docs = np.full((len(ids), 2 * k), -1.0), np.zeros((len(ids), 2 * k), np.int64)
        for rows in batches:
            for i in range(rows.num_rows):
                row = {c: rows[c][i].values.to_numpy() for c in ("ids", "lengths", "terms", "counts")}
                row |= {c: _unpacked(rows[c][i], row["counts"].sum()) for c in ("docs", "freqs")}
                shard = Shard(row, mean_length, (terms, weights))
                least = scores[:, :k].min(1)
                for q, (s, d) in enumerate(shard.best(terms, None, bounds, k, which, least)):
                    scores[q, k : k + len(s)], docs[q, k : k + len(s)] = s, d
                order = np.lexsort((docs, -scores), axis=1)
                scores, docs = np.take_along_axis(scores, order, 1), np.take_along_axis(docs, order, 1)
                scores[:, k:] = -1
        found = scores[:, :k] >= 0
        some = np.flatnonzero(found.any(1))
        offsets = np.concatenate(([0], np.cumsum(found[some].sum(1)))).astype(np.int32)
        hits = pa.StructArray.from_arrays([pa.array(-scores[:, :k][found]), pa.array(docs[:, :k][found])], fields=list(hit))
        yield pa.RecordBatch.from_arrays([pa.array(ids[some]), pa.ListArray.from_arrays(pa.array(offsets), hits)], ["query_id", "hits"])

    return run


def _blocks(weighed: DataFrame) -> tuple[DataFrame, int]:
    """Queries (query_id, terms with their weights) in a written table with a folder for each block."""
    packed = stored(
        weighed.groupBy("query_id").agg(F.sort_array(F.collect_list("t")).alias("terms")).select(
            "query_id", F.col("terms.term").alias("terms"), F.col("terms.idf").alias("weights")
        ),
        "queries",
    )
    total, number = packed.agg(F.sum(F.size("terms")), F.count("*")).first()
    count = max(-(-(total or 0) // BLOCK_TERMS), -(-number // BLOCK_QUERIES))
    block = F.pmod(F.xxhash64("query_id"), F.lit(max(count, 1))).cast("int")
    return packed.withColumn("block", block), count


def search(shards: DataFrame, queries: DataFrame, k: int = K) -> DataFrame:
    """query_id, rank, doc_id and score of the k best documents of each query (query_id, text)."""
    spark = shards.sparkSession
    ship_package(spark)
    totals = shards.select(F.size("ids").alias("n"), F.aggregate("lengths", F.lit(0).cast("long"), lambda s, x: s + x).alias("words")).agg(
        F.sum("n").alias("n"), F.sum("words").alias("words")
    ).first()
    if not totals["n"]:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    asked = queries.select(F.col("query_id").cast("long"), F.col("text").cast("string")).where("query_id is not null")
    terms = asked.mapInArrow(_asking, "query_id long, terms array<long>").select("query_id", F.explode("terms").alias("term")).distinct()
    counts = (
        shards.select(F.explode(F.arrays_zip("terms", "counts")).alias("t"))
        .groupBy(F.col("t.terms").alias("term"))
        .agg(F.sum("t.counts").alias("df"))
    )
    idf = F.log(1 + (totals["n"] - F.col("df") + 0.5) / (F.col("df") + 0.5))
    weighed = terms.join(counts, "term").select("query_id", F.struct("term", idf.alias("idf")).alias("t"))
    packed, count = _blocks(weighed)
    if not count:
        return spark.createDataFrame([], "query_id long, rank int, doc_id long, score double")
    answers = f"{shared_dir(spark)}/llm/answers-{uuid.uuid4().hex}"
    cores = spark.sparkContext.defaultParallelism
    tasks = max(cores, min(4 * cores, TASKS))
    for number in range(count):
        block = _shipped_block(packed.where(F.col("block") == number))
        try:
            if not len(block.value[0]):
                continue
            run = _answering(block, totals["words"] / totals["n"], k)
            # One shard to a batch: a worker holds no other.
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", 1)
            shards.drop("shard").coalesce(tasks).mapInArrow(run, ANSWER).write.mode("append").parquet(answers)
        finally:
            spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
            block.destroy()
    best = spark.read.schema(ANSWER).parquet(answers).groupBy("query_id").agg(
        F.slice(F.array_sort(F.flatten(F.collect_list("hits"))), 1, k).alias("hits")
    )
    return best.select("query_id", F.posexplode("hits").alias("rank", "hit")).select(
        "query_id",
        (F.col("rank") + 1).alias("rank"),
        F.nullif(F.col("hit.doc"), F.lit(_NO_ID)).alias("doc_id"),
        (-F.col("hit.minus")).alias("score"),
    )


def _shipped_block(packed: DataFrame) -> Broadcast:
    """One block of queries, of bounded size, as arrays for every worker."""
    found = packed.select("query_id", "terms", "weights").toArrow().combine_chunks()
    lists = found["terms"].combine_chunks()
    bounds = np.concatenate(([0], np.cumsum(pc.list_value_length(lists).to_numpy(), dtype=np.int64)))
    weights = found["weights"].combine_chunks().flatten().to_numpy()
    terms, first, which = np.unique(lists.flatten().to_numpy(), return_index=True, return_inverse=True)
    arrays = (found["query_id"].to_numpy(), bounds, terms, which.astype(np.int32), weights[first])
    return packed.sparkSession.sparkContext.broadcast(arrays)


def every_twentieth(doc_id: Column) -> Column:
    """The stated query set."""
    return doc_id % 20 == 0
