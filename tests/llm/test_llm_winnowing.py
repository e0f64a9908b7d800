"""Fingerprints against a window-by-window version, and the guarantee they give."""

import hashlib
import random

import numpy as np
import pyarrow as pa
import pytest
from odd_rows import empty_documents, odd_documents
from pyspark.sql import functions as F

from fleetpulse.llm import queries, winnowing
from fleetpulse.llm.common import table
from fleetpulse.llm.text import Batch

SF = "/root/testdata/sf0.01"


def plain_prints(text, gram, window):
    """(position, hash) of the rightmost least gram of each window, one window at a time."""
    if not text:
        return set()
    grams = [text[i : i + gram] for i in range(max(len(text) - gram + 1, 1))]
    known = {}
    for g in grams:
        if g not in known:
            batch = Batch(pa.array([g]))
            known[g] = int(batch.hashes(np.array([0]), np.array([len(batch.data)]))[0])
    hashes = [known[g] for g in grams]
    kept = set()
    for i in range(max(len(hashes) - window + 1, 1)):
        some = range(i, min(i + window, len(hashes)))
        best = min(some, key=lambda j: (hashes[j] >> 32, -j))
        kept.add((best, hashes[best]))
    return kept


def jaccard(a, b):
    a, b = {h for _, h in a}, {h for _, h in b}
    return len(a & b) / len(a | b) if a | b else 1.0


def got_prints(df):
    return {
        r["doc_id"]: {(p, h % 2**64) for p, h in zip(r["positions"], r["hashes"])} for r in df.collect()
    }


@pytest.mark.parametrize(("gram", "window"), [(1, 1), (3, 4), (5, 7), (32, 64)])
def test_prints_equal_the_plain_version(spark, gram, window):
    rnd = random.Random(gram)
    texts = ["", "a", "ab", "aaaaaaaaaaaa", "é" * 9, "漢字\U0001f600x" * 30]
    texts += ["".join(rnd.choice("ab é\n") for _ in range(rnd.randrange(200))) for _ in range(40)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = got_prints(winnowing.fingerprints(df, gram=gram, window=window))
    assert got == {i: plain_prints(t, gram, window) for i, t in enumerate(texts)}


def test_shared_passages_share_a_print(spark):
    rnd = random.Random(4)
    word = lambda: "".join(rnd.choice("abcdefgh ") for _ in range(rnd.randrange(50, 400)))
    length = winnowing.GRAM + winnowing.WINDOW - 1
    rows = []
    for i in range(0, 60, 2):
        passage = "".join(rnd.choice("abcdefgh ") for _ in range(length))
        rows += [(i, word() + passage + word()), (i + 1, word() + passage + word())]
    got = got_prints(winnowing.fingerprints(spark.createDataFrame(rows, "doc_id long, text string")))
    assert all({h for _, h in got[i]} & {h for _, h in got[i + 1]} for i in range(0, 60, 2))


def plain_comparison(rows):
    out = {}
    rows = sorted(rows, key=lambda r: -r[0])
    for (i, text), (_, after) in zip(rows, rows[1:] + rows[:1]):
        new = winnowing.edited(text, after)
        own = plain_prints(text, winnowing.GRAM, winnowing.WINDOW)
        out[i] = (
            len(text),
            hashlib.sha256(new.encode()).hexdigest(),
            jaccard(own, plain_prints(new, winnowing.GRAM, winnowing.WINDOW)),
            jaccard(own, plain_prints(after, winnowing.GRAM, winnowing.WINDOW)),
        )
    return out


def test_op13_against_the_plain_version(spark):
    rows = [(r["doc_id"], r["text"] or "") for r in table(spark, SF, "documents").orderBy(F.length("text")).limit(300).collect()]
    df = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    got = winnowing.compare_next(df).collect()
    expected = plain_comparison(rows)
    assert len(got) == len(rows)
    for r in got:
        n, new, near, following = expected[r["doc_id"]]
        assert (r["n_chars"], r["edited_sha256"]) == (n, new)
        assert r["near_edited"] == pytest.approx(near, abs=1e-12) and r["near_next"] == pytest.approx(following, abs=1e-12)


def test_op13_whole_table(spark):
    got = queries.op13_winnowing(spark, SF)
    docs = {r["doc_id"]: r["text"] or "" for r in table(spark, SF, "documents").collect()}
    rows = got.collect()
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    prints = {}
    for r in rows:
        prints.setdefault(docs[r["doc_id"]], set()).add(r["fingerprint"])
        assert 0 <= r["near_edited"] <= 1 and 0 <= r["near_next"] <= 1
    assert all(len(p) == 1 for p in prints.values())
    assert len({p for s in prints.values() for p in s}) > 0.99 * len(prints)


def test_odd_rows(spark):
    docs = odd_documents(spark)
    got = winnowing.compare_next(docs).collect()
    assert sorted((r["doc_id"] is not None, r["doc_id"] or 0) for r in got) == sorted(
        (r["doc_id"] is not None, r["doc_id"] or 0) for r in docs.collect()
    )
    empty = hashlib.sha256(b"").hexdigest()
    assert {r["fingerprint"] for r in got if r["n_chars"] == 0} == {empty}
    # Null ids come last: the very last is followed by the document of the largest id.
    last = [r for r in got if r["doc_id"] is None]
    assert len(last) == 2 and all(0 <= r["near_next"] <= 1 for r in got)
    one = docs.where("doc_id = 5")
    assert [(r["near_next"], r["near_edited"] > 0.3) for r in winnowing.compare_next(one).collect()] == [(1.0, True)]
    assert winnowing.compare_next(empty_documents(spark)).count() == 0
    assert winnowing.fingerprints(empty_documents(spark)).count() == 0
    assert winnowing.fingerprints(docs).count() == docs.count()
