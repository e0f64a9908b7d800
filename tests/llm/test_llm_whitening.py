"""Whitening against numpy's eigenvectors, and odd vectors."""

import math

import numpy as np
import pytest

from fleetpulse.llm import queries, whitening
from fleetpulse.llm.common import table

SF = "/root/testdata/sf0.01"
SCHEMA = "vec_id long, embedding array<float>"


def integers(vectors):
    return np.floor(1024 * np.array(vectors, np.float64)).astype(np.int64) + 100_000


def check(rows, ids, x, tolerance=1e-7):
    """rows of whiten against the eigenvectors of the covariance of x."""
    n, d = x.shape
    sums = x.sum(0)
    y = (n * x - sums) / n
    values, vectors = np.linalg.eigh(y.T @ y / n)
    values, vectors = values[::-1], vectors[:, ::-1]
    k = min(8, int((values > 1e-10 * values[0]).sum()))
    got = {(r["vec_id"], r["component"]): r for r in rows}
    assert len(rows) == len(got) == n * k
    for c in range(k):
        mine = np.array([got[i, c + 1]["whitened"] for i in ids])
        theirs = y @ vectors[:, c] / math.sqrt(values[c])
        sign = np.sign(mine @ theirs)
        assert np.abs(mine - sign * theirs).max() < tolerance * max(1, np.abs(theirs).max())
        assert got[ids[0], c + 1]["explained"] == pytest.approx(values[c] / values.sum(), rel=1e-9)
    for i, row in zip(ids, n * x.astype(object) - sums.astype(object)):
        assert got[i, 1]["deviation"] == int((row**2).sum()) and got[i, 1]["n"] == n
    assert len({r["identity_error"] for r in rows}) == 1 and rows[0]["identity_error"] < 1e-8
    white = np.array([[got[i, c + 1]["whitened"] for c in range(k)] for i in ids])
    assert np.abs(white.T @ white / n - np.eye(k)).max() < 1e-8


def test_op11_equals_eigenvectors(spark):
    rows = [(r["vec_id"], r["embedding"]) for r in table(spark, SF, "embeddings").collect() if r["embedding"] is not None]
    kept = [(i, v) for i, v in rows if all(c is not None and math.isfinite(c) for c in v)]
    check(queries.op11_embedding_whitening(spark, SF).collect(), [i for i, _ in kept], integers([v for _, v in kept]))


def test_filter_finds_the_components_of_a_flat_spectrum():
    random = np.random.default_rng(5)
    basis = np.linalg.qr(random.standard_normal((300, 300)))[0]
    spectrum = np.concatenate((np.linspace(1.3, 1.1, 8), np.linspace(1.05, 0.2, 292)))
    v = (basis * spectrum) @ basis.T
    passes = []

    def times(q):
        passes.append(q.shape[1])
        return v @ q, float(spectrum.sum())

    values, vectors, trace = whitening.leading(times, 300, 8)
    assert np.abs(values - spectrum[:8]).max() < 1e-12
    assert np.abs(np.abs((basis[:, :8] * vectors).sum(0)) - 1).max() < 1e-9
    assert set(passes) == {whitening.BLOCK} and len(passes) < 400


def test_small_and_flat_dimensions(spark):
    random = np.random.default_rng(2)
    for n, d in ((50, 1), (40, 3), (5, 20)):
        vectors = random.standard_normal((n, d)).astype(np.float32)
        rows = [(i, [float(c) for c in v]) for i, v in enumerate(vectors)]
        got = whitening.whiten(spark.createDataFrame(rows, SCHEMA)).collect()
        check(got, list(range(n)), integers(vectors))


def test_odd_vectors(spark):
    nan, inf = float("nan"), float("inf")
    rows = [(1, [1.0, 2.0]), (1, [1.0, 2.0]), (None, [0.5, -2.0]), (2, None), (3, [None, 1.0]), (4, [nan, 1.0]),
            (5, [inf, 0.0]), (6, [-inf, 0.0]), (7, [3.0]), (8, []), (9, [2.0, 7.0])]
    extra = "n string, x int, i int, q string, c double"
    df = spark.createDataFrame([(*r, "a", 1, 2, "b", 0.5) for r in rows], f"{SCHEMA}, {extra}")
    got = whitening.whiten(df).collect()
    assert sorted({r["vec_id"] for r in got}, key=str) == [1, 7, 8, 9, None] and len(got) == 2 * 6
    x = integers([[1, 2], [1, 2], [0.5, -2], [3, 0], [0, 0], [2, 7]])
    away = 6 * x - x.sum(0)
    deviations = {i: int((row**2).sum()) for i, row in zip((1, 1, None, 7, 8, 9), away)}
    assert all(r["deviation"] == deviations[r["vec_id"]] and r["n"] == 6 for r in got)
    assert got[0]["identity_error"] < 1e-9
    for few in ([], [(1, [1.0, 2.0])], [(1, [1.0]), (2, [1.0])], [(1, None)], [(1, [])]):
        assert whitening.whiten(spark.createDataFrame(few, SCHEMA)).count() == 0
    # Entries far out: no overflow, and what no long can hold is null.
    far = whitening.whiten(spark.createDataFrame([(1, [3e38]), (2, [-3e38]), (3, [0.0])], SCHEMA)).collect()
    assert {r["vec_id"]: r["deviation"] for r in far} == {1: None, 2: None, 3: 0}
