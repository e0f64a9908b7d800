"""Whitening of embeddings on their leading principal components, by Chebyshev-filtered subspace iteration.

Entries become integers, x = floor(SCALE * c) + SHIFT, so that counts and sums are exact. The covariance V is never
formed: it is known by V Q = sum of y (y' Q) / n over the centred vectors y, one pass over the written integers that every
task reduces to a block of the vectors' dimension before its shuffle. A round takes one such pass for a Rayleigh-Ritz
step, which gives the block's best eigenvectors and their residuals, and then filters the block: a Chebyshev polynomial
of V, by its three-term recurrence with a pass for each degree, stays below one on the unwanted spectrum (from zero to the
block's least Ritz value) and grows steeply above it. QR makes the block orthonormal again. Each round FRESH random
directions take the place of the block's last ones, so that a direction the block had missed would come up in it.

The result is certified: rounds end when the residual of every wanted component is below TOLERANCE times the largest
eigenvalue (or cannot fall any more) in a round with fresh directions after the first. If that is not reached in
MAX_ROUNDS, an error is raised.

Null vectors and vectors with null, NaN or infinite entries are dropped. Vectors of unequal length count as filled up with
zeros to the longest; an empty vector is all zeros. Entries beyond 2**40 count as 2**40. A deviation beyond a long is null.
Null vec_id: a row like any other. Repeated rows: each counts and gets its own result. Directions without variance (up
to rounding) are no components: equal vectors, or a single one, give no rows. Ties among eigenvalues: any orthonormal
basis of their space, the same for all rows. Empty tables give no rows. Extra columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import ship_package, stored

COMPONENTS = 8
SCALE, SHIFT = 1024, 100_000
BLOCK = 32
FRESH = 4
MAX_DEGREE = 24
#: The largest and the least of a block may grow apart by so much in a round.
MAX_GROWTH = 1e12
TOLERANCE = 2e-14
#: Residuals this small are accepted once a round no longer halves them.
STALLED = 1e-11
MAX_ROUNDS = 200
RANK = 1e-12
_MOST = float(1 << 40)
WHITENED = (
    "vec_id long, component int, n long, deviation long, whitened double, explained double, identity_error double"
)


def integers(embeddings: DataFrame) -> DataFrame:
    """(vec_id, x) of the vectors that remain, written."""
    vector = F.col("embedding").cast("array<double>")
    finite = F.forall("c", lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) < float("inf")))
    scaled = F.transform("c", lambda c: F.floor(F.greatest(F.least(c * SCALE, F.lit(_MOST)), F.lit(-_MOST))) + SHIFT)
    kept = embeddings.select(F.col("vec_id").cast("long"), vector.alias("c")).where(F.col("c").isNotNull() & finite)
    return stored(kept.select("vec_id", scaled.cast("array<long>").alias("x")), "vectors")


def _matrix(x: pa.ListArray, d: int) -> np.ndarray:
    """Rows of equal length, filled up with what a zero entry becomes."""
    flat = x.flatten().to_numpy(zero_copy_only=False)
    sizes = x.value_lengths().to_numpy(zero_copy_only=False)
    if len(flat) == len(sizes) * d:
        return flat.reshape(len(sizes), d)
    out = np.full((len(sizes), d), SHIFT, np.int64)
    out[np.arange(d) < sizes[:, None]] = flat
    return out


@dataclass
class Totals:
    """Number of vectors, and the exact sum of each dimension."""

    n: int
    sums: np.ndarray

    def away(self, x: np.ndarray) -> np.ndarray:
        """n x - S as integers: of 64 bits, or of any size where those may not do."""
        most = max(int(np.abs(x).max(initial=0)), 1)
        return self.n * (x if self.n * most < 2**62 else x.astype(object)) - self.sums

    def centred(self, x: np.ndarray) -> np.ndarray:
        return self.away(x).astype(float) / self.n


def totals(vectors: DataFrame) -> Totals:
    d = vectors.agg(F.max(F.size("x"))).first()[0] or 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums = 0, np.zeros(d, np.int64)
        for rows in batches:
            n += rows.num_rows
            sums += _matrix(rows["x"], d).sum(0)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(d)), pa.array(sums), pa.array([n] * d, pa.int64())], ["i", "s", "n"])

    sums = vectors.select("x").mapInArrow(run, "i long, s long, n long").groupBy("i").agg(F.sum("s").alias("s"), F.sum("n").alias("n"))
    rows = sorted(sums.collect())
    return Totals(rows[0]["n"] if rows else 0, np.array([r["s"] for r in rows], np.int64))


def covariance_times(vectors: DataFrame, of: Totals) -> Callable[[np.ndarray], tuple[np.ndarray, float]]:
    """V Q for a block Q, and the trace of V: one pass over the vectors."""
    context = vectors.sparkSession.sparkContext

    def times(q: np.ndarray) -> tuple[np.ndarray, float]:
        d, m = q.shape
        given = context.broadcast((of, q))

        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            of, q = given.value
            out = np.zeros((d + 1, m))
            for rows in batches:
                y = of.centred(_matrix(rows["x"], d))
                out[:d] += y.T @ (y @ q)
                out[d] += np.square(y).sum()
            lists = pa.ListArray.from_arrays(pa.array(np.arange(0, (d + 1) * m + 1, m), pa.int32()), pa.array(out.ravel()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(d + 1)), lists], ["i", "q"])

        # One row for each dimension and task, summed by Spark.
        parts = vectors.select("x").mapInArrow(run, "i long, q array<double>")
        rows = parts.groupBy("i").agg(*[F.sum(F.col("q")[j]).alias(f"q{j}") for j in range(m)]).collect()
        given.destroy()
        out = np.zeros((d + 1, m))
        for row in rows:
            out[row["i"]] = row[1:]
        return out[:d] / of.n, float(out[d, 0] / of.n)

    return times


def leading(times: Callable[[np.ndarray], tuple[np.ndarray, float]], d: int, k: int, *, block: int = BLOCK, seed: int = 1) -> tuple[np.ndarray, np.ndarray, float]:
    """The k largest eigenvalues, their eigenvectors and the trace, certified."""
    random = np.random.default_rng(seed)
    m = min(d, max(block, 2 * k))
    q = np.linalg.qr(random.standard_normal((d, m)))[0]
    before = np.inf
    for turn in range(MAX_ROUNDS):
        w, trace = times(q)
        values, rotation = np.linalg.eigh((q.T @ w + w.T @ q) / 2)
        values, rotation = values[::-1], rotation[:, ::-1]
        q, w = q @ rotation, w @ rotation
        if values[0] <= 0:
            return values[:0], q[:, :0], trace
        wanted = min(k, int((values > RANK * values[0]).sum()))
        worst = np.linalg.norm(w - q * values, axis=0)[:wanted].max() / values[0]
        done = worst <= TOLERANCE or (worst <= STALLED and worst > before / 2)
        if m == d or (done and turn):
            return values[:wanted], q[:, :wanted], trace
        before = worst
        cut = max(values[-1], RANK * values[0])
        reach = np.arccosh(max(2 * values[0] / cut - 1, 1 + 1e-9))
        degree = int(np.clip(np.log(MAX_GROWTH) / reach, 2, MAX_DEGREE))
        q[:, m - FRESH :] = random.standard_normal((d, FRESH))
        q = np.linalg.qr(_filtered(lambda x: times(x)[0], q, degree, cut, values[0]))[0]
    raise ArithmeticError(f"not certified after {MAX_ROUNDS} rounds: residual {worst:g}")


def _filtered(times: Callable[[np.ndarray], np.ndarray], x: np.ndarray, degree: int, cut: float, top: float) -> np.ndarray:
    """The Chebyshev polynomial of the interval from zero to `cut`, of V, on a block; scaled to one at `top`."""
    half = cut / 2
    sigma = first = half / (top - half)
    y = (times(x) - half * x) * (first / half)
    for _ in range(degree - 1):
        following = 1 / (2 / first - sigma)
        x, y = y, (times(y) - half * y) * (2 * following / half) - x * (sigma * following)
        sigma = following
    return y


def whiten(embeddings: DataFrame, *, components: int = COMPONENTS) -> DataFrame:
    """WHITENED: a row for each vector and component, numbered from 1 by falling eigenvalue."""
    spark = embeddings.sparkSession
    ship_package(spark)
    vectors = integers(embeddings)
    of = totals(vectors)
    d = len(of.sums)
    if not d:
        return spark.createDataFrame([], WHITENED)
    times = covariance_times(vectors, of)
    values, basis, trace = leading(times, d, components)
    k = len(values)
    if not k:
        return spark.createDataFrame([], WHITENED)
    matrix = basis / np.sqrt(values)
    error = float(np.abs(matrix.T @ times(matrix)[0] - np.eye(k)).max())
    explained = values / trace
    given = spark.sparkContext.broadcast((of, matrix, explained, error))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of, matrix, explained, error = given.value
        for rows in batches:
            away, r = of.away(_matrix(rows["x"], d)), rows.num_rows
            near = np.square(away.astype(float)).sum(1)
            exact = np.square(away if near.max(initial=0) < 2**62 else away.astype(object)).sum(1).tolist()
            deviation = pa.array([v if v < 2**63 else None for v in exact], pa.int64())
            each = np.repeat(np.arange(r), k)
            yield pa.RecordBatch.from_arrays(
                [
                    rows["vec_id"].take(pa.array(each)),
                    pa.array(np.tile(np.arange(1, k + 1, dtype=np.int32), r)),
                    pa.array(np.full(r * k, of.n)),
                    deviation.take(pa.array(each)),
                    pa.array((away.astype(float) / of.n @ matrix).ravel()),
                    pa.array(np.tile(explained, r)),
                    pa.array(np.full(r * k, error)),
                ],
                [c.split(" ")[0] for c in WHITENED.split(", ")],
            )

    return vectors.mapInArrow(run, WHITENED)
