"""Document quality by hierarchical empirical Bayes: a classifier's evidence and the record of the document's site.

The classifier gives each document a probability of good quality from measures of its whole text. Those probabilities
are added up by path and by host (grouped sums, combined before they are shuffled). A host's rate is shrunk towards the
rate of all, a path's towards its host's, the more the fewer documents there are; how much follows from how far sites
differ beyond chance (method of moments). A document's own share is left out of the rates it is judged by. The odds of
the document are its classifier's odds times the odds of its path against those of all.

Null or empty text: measures of nothing, which the classifier judges like any others. Very long texts: measured whole.
Ties: a probability of exactly min_probability is kept. Null host or path: a site of its
own. Null doc_id: passed on. Repeated rows: each counts. No labels, or one class only: every document has the
probability 0.5 before sites. Extra columns are ignored. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fleetpulse.llm.common import hash_sample, ship_package, slices, stored
from fleetpulse.llm.linear import fit_logistic, fit_platt, sigmoid
from fleetpulse.llm.text import Batch, occurrence

#: Labelled rows to fit on, at most; a third of them calibrates.
TRAINING_ROWS = 4000
MIN_PROBABILITY = 0.5
_LEAST, _MOST = 1e-4, 1 - 1e-4


def _among(characters: bytes) -> np.ndarray:
    out = np.zeros(256, np.uint8)
    out[list(characters)] = 1
    return out


_CLASSES = [
    _among(bytes(range(ord("A"), ord("Z") + 1))),
    _among(b"0123456789"),
    _among(b"#*$%&<>@^~=+"),
    _among(b"|"),
    _among(b"!?"),
    _among(b".,;:"),
    _among(b"()[]{}/\\_"),
]
MEASURES = len(_CLASSES) + 7


def measures(batch: Batch) -> np.ndarray:
    """One row of measures for each text."""
    length = np.maximum(np.diff(batch.doc_bounds), 1)
    words = np.diff(batch.word_bounds)
    some = np.maximum(words, 1)
    hashes = batch.word_hashes()
    sizes = batch.ends - batch.starts
    per_text = lambda x: np.bincount(batch.word_row, x, batch.rows)
    same_row = np.concatenate(([False], batch.word_row[1:] == batch.word_row[:-1])) if len(hashes) else np.zeros(0, bool)
    again = np.concatenate(([False], hashes[1:] == hashes[:-1])) & same_row if len(hashes) else np.zeros(0, bool)
    starts, ends, line_rows, line_words = batch.lines()
    full = line_words > 0
    lines = np.maximum(np.bincount(line_rows[full], minlength=batch.rows), 1)
    repeated = occurrence(batch.hashes(starts[full], ends[full]), line_rows[full]) > 0
    columns = [np.sqrt(batch.per_row(c[batch.data]) / length) for c in _CLASSES]
    columns += [
        np.log1p(words),
        per_text(sizes) / some / 10,
        per_text(sizes == 1) / some,
        per_text(sizes > 20) / some,
        np.sqrt(per_text(again) / some),
        per_text(occurrence(hashes, batch.word_row) > 0) / some,
        np.bincount(line_rows[full], repeated, batch.rows) / lines,
    ]
    return np.column_stack(columns)


@dataclass
class Model:
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float
    intercept: float

    def probability(self, x: np.ndarray) -> np.ndarray:
        margin = ((x - self.mean) / self.scale) @ self.weights + self.bias
        return sigmoid(self.slope * margin + self.intercept)


def _measuring(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for rows in batches:
        for a, b in slices(rows["text"]):
            x = measures(Batch(rows["text"].slice(a, b - a)))
            lists = pa.FixedSizeListArray.from_arrays(pa.array(x.ravel()), MEASURES).cast(pa.list_(pa.float64()))
            yield pa.RecordBatch.from_arrays([rows["quality"].slice(a, b - a), lists], ["quality", "x"])


def train(documents: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Model | None:
    """Fit the document classifier on at most so many labelled rows; None without two classes."""
    ship_package(documents.sparkSession)
    known = labels.select("doc_id", F.col("quality").cast("int").alias("quality")).where("doc_id is not null and quality in (0, 1)")
    texts = documents.select("doc_id", "text").join(F.broadcast(hash_sample(known, "doc_id", rows)), "doc_id")
    found = texts.select("quality", "text").mapInArrow(_measuring, "quality int, x array<double>").toArrow()
    y = found["quality"].to_numpy().astype(float)
    if not (0 < y.sum() < len(y)):
        return None
    x = np.array(found["x"].to_pylist())
    mean, scale = x.mean(0), x.std(0) + 1e-6
    z = (x - mean) / scale
    held = np.argsort(np.argsort(-y, kind="stable"), kind="stable") % 3 == 2
    if not (0 < y[held].sum() < held.sum()):
        held = np.zeros(len(y), bool)
    fit = z[~held]
    row, column = np.repeat(np.arange(len(fit)), MEASURES), np.tile(np.arange(MEASURES), len(fit))
    weights, bias = fit_logistic(row, column, fit.ravel(), y[~held], MEASURES, l2=1e-3, steps=400)
    check = held if held.any() else ~held
    slope, intercept = fit_platt(z[check] @ weights + bias, y[check])
    return Model(mean, scale, weights, bias, slope, intercept)


def evidence(documents: DataFrame, model: Model | None, host: Column, path: Column) -> DataFrame:
    """doc_id, host, path (as text, one for each site) and the classifier's probability."""
    ship_package(documents.sparkSession)
    shared = documents.sparkSession.sparkContext.broadcast(model)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = shared.value
        for rows in batches:
            for a, b in slices(rows["text"]):
                if m is None:
                    p = np.full(b - a, 0.5)
                else:
                    p = np.clip(m.probability(measures(Batch(rows["text"].slice(a, b - a)))), _LEAST, _MOST)
                kept = [rows[c].slice(a, b - a) for c in ("doc_id", "host", "path")]
                yield pa.RecordBatch.from_arrays([*kept, pa.array(p)], ["doc_id", "host", "path", "evidence"])

    narrow = documents.select(
        F.col("doc_id").cast("long"),
        F.to_json(F.struct(host.alias("host"))).alias("host"),
        F.to_json(F.struct(host.alias("host"), path.alias("path"))).alias("path"),
        F.col("text").cast("string"),
    )
    return narrow.mapInArrow(run, "doc_id long, host string, path string, evidence double")


def strength(sites: DataFrame, parent: str) -> float:
    """How many documents the rate of the level above is worth: from the spread of the sites' rates around it, less what
    chance alone would give. sites has n and s (sum of probabilities), and the column of the level above's rate."""
    rate = F.col("s") / F.col("n")
    m = F.col(parent)
    row = sites.select(
        F.sum(F.col("n") * (rate - m) ** 2).alias("spread"),
        F.sum(m * (1 - m)).alias("chance"),
        F.sum("n").alias("n"),
        F.sum(F.col("n") * m * (1 - m)).alias("unit"),
    ).first()
    if not row["n"]:
        return 1.0
    between = max(row["spread"] - row["chance"], 0.0) / row["n"]
    unit = row["unit"] / row["n"]
    return float(min(max(unit / between - 1 if between > 1e-9 else 1e6, 1.0), 1e6))


def _logit(p: Column) -> Column:
    p = F.greatest(F.least(p, F.lit(_MOST)), F.lit(_LEAST))
    return F.log(p / (1 - p))


def posteriors(found: DataFrame, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """What `evidence` found, with each document's host and path posterior, the combined probability, and kept.

    Reads the rows several times: give it a written table.
    """
    paths = stored(found.groupBy("host", "path").agg(F.count("*").alias("n"), F.sum("evidence").alias("s")), "paths")
    total = paths.agg(F.sum("n").alias("n"), F.sum("s").alias("s")).first()
    prior = total["s"] / total["n"] if total["n"] else 0.5
    hosts = paths.groupBy("host").agg(F.sum("n").alias("n"), F.sum("s").alias("s"))
    k_host = strength(hosts.withColumn("above", F.lit(prior)), "above")
    host_rate = (F.col("host_s") + k_host * F.lit(prior)) / (F.col("host_n") + k_host)
    sites = stored(
        paths.join(hosts.select("host", F.col("n").alias("host_n"), F.col("s").alias("host_s")), "host").withColumn(
            "above", host_rate
        ),
        "sites",
    )
    k_path = strength(sites, "above")
    own = F.col("evidence")
    host_posterior = (F.col("host_s") - own + k_host * F.lit(prior)) / (F.col("host_n") - 1 + k_host)
    path_posterior = (F.col("s") - own + k_path * F.col("host_posterior")) / (F.col("n") - 1 + k_path)
    odds = _logit(own) + _logit(F.col("path_posterior")) - _logit(F.lit(prior))
    return (
        found.join(sites.select("path", "n", "s", "host_n", "host_s"), "path")
        .withColumn("host_posterior", host_posterior)
        .withColumn("path_posterior", path_posterior)
        .withColumn("probability", 1 / (1 + F.exp(-odds)))
        .select(
            "doc_id", "host", "path", "evidence", "host_posterior", "path_posterior", "probability",
            (F.col("probability") >= min_probability).alias("kept"),
        )
    )


def url_site(url: Column) -> tuple[Column, Column]:
    """Host (without www.) and first folder of an address, for tables that have one."""
    host = F.regexp_replace(F.lower(F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#:]*)", 1)), r"^www\.", "")
    return host, F.regexp_extract(url, r"^[a-zA-Z][a-zA-Z0-9+.-]*://[^/?#]*/([^/?#]*)", 1)


def judge(documents: DataFrame, model: Model | None, host: Column, path: Column, min_probability: float = MIN_PROBABILITY) -> DataFrame:
    """Evidence and posteriors of the documents."""
    return posteriors(stored(evidence(documents, model, host, path), "evidence"), min_probability)


def judge_by(documents: DataFrame, labels: DataFrame, sites: Sequence[str] = ("source", "lang")) -> DataFrame:
    """With sites named by two columns, the wider first."""
    return judge(documents, train(documents, labels), F.col(sites[0]), F.col(sites[1]))
