"""Each operator on nulls, empty and long texts, repeated rows, empty tables and extra columns of clashing names."""

import pytest
from odd_rows import empty_documents, labels, odd_documents
from pyspark.sql import functions as F

from fleetpulse.llm import (
    licenses,
    line_dedup,
    mixing,
    order_minhash,
    packing,
    quality_rules,
    search,
    site_quality,
    toxicity,
    warc,
)


@pytest.fixture(scope="module")
def docs(spark):
    return odd_documents(spark).cache()


def ids(df, name="doc_id"):
    return sorted((r[name] for r in df.select(name).collect()), key=lambda x: (x is not None, x or 0))


ALL = [None, None, -7, 1, 1, 1, 2, 3, 4, 5, 6]


def test_licenses(spark, docs):
    model = licenses.train(docs)
    found = licenses.scan(docs, model)
    assert ids(found) == ALL and found.where("family is not null").count() == 0
    assert licenses.scan(empty_documents(spark), model).count() == 0
    assert licenses.train(empty_documents(spark)).families == model.families


def test_site_quality(spark, docs):
    found = site_quality.judge_by(docs, labels(spark))
    assert ids(found) == ALL and found.where("evidence <> 0.5 or probability is null").count() == 0
    assert site_quality.judge_by(docs, labels(spark, [(1, None, 1), (None, 1, 0), (2, 1, None)])).count() == 11
    assert site_quality.judge_by(empty_documents(spark), labels(spark)).count() == 0


def test_toxicity(spark, docs):
    found = toxicity.score(docs, toxicity.train(docs, labels(spark)))
    assert ids(found) == ALL and found.where("score <> 0 or predicted <> 0").count() == 0
    assert not found.where("doc_id is null and held_out").count()
    model = toxicity.fit([["idiot", "is"], ["idiot", "was"], ["tree", "is"], ["house", "was"]] * 6, [1, 1, 0, 0] * 6)
    scored = {r["doc_id"]: r["score"] for r in toxicity.score(docs, model).collect()}
    assert scored[-7] > 0.5 > max(scored[2], scored[3], scored[4])
    assert toxicity.score(empty_documents(spark), model).count() == 0


def test_line_dedup(spark, docs):
    found = line_dedup.dedup_lines(docs, min_block_words=5)
    assert [c for c in found.columns if c != "deleted_lines"] == docs.columns
    rows = [(r["doc_id"], r["text"], r["deleted_lines"], r["_key"]) for r in found.collect()]
    prose = [r for r in rows if r[0] in (None, 1) and (r[2] or (r[1] or "").startswith("one"))]
    # The null id comes first and keeps its line; the repeated rows are one document and lose it alike.
    assert sorted(prose, key=str) == sorted(
        [(None, docs.where("doc_id is null and text is not null").first()["text"], 0, "k"), (1, "", 1, "k"), (1, "", 1, "k")],
        key=str,
    )
    assert ids(found) == ALL
    assert line_dedup.dedup_lines(empty_documents(spark)).count() == 0


def test_packing(spark, docs):
    found = packing.pack_documents(docs, packing.word_tokenizer()).cache()
    assert ids(found.where("piece = 0")) == ALL
    empty = found.where("doc_id in (2, 3, 4)").collect()
    assert [r["ids"] for r in empty] == [[packing.END_ID]] * 3
    assert found.where("doc_id = 5").count() > 5
    assert packing.pack_documents(empty_documents(spark), packing.word_tokenizer()).count() == 0


def test_mixing(spark, docs):
    rows, plan = mixing.mix(docs)
    assert ids(rows) == ALL and rows.where("taken > 2 * size or taken < 0").count() == 0
    assert set(plan.sources) == {"a", "b", "c", None}
    again = mixing.mixed(docs)
    assert again.columns == docs.columns
    assert again.select(F.sum(F.coalesce(F.regexp_count("text", F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)))).first()[0] == rows.select(F.sum("taken")).first()[0]
    assert mixing.mix(empty_documents(spark))[0].count() == 0
    assert mixing.mixed(empty_documents(spark)).count() == 0


def test_warc(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string, digest string, held int")
    folder = warc.archive_folder(spark)
    warc.write_archives(pages, folder)
    assert warc.captures(spark, folder).count() == 0


def test_search(spark, docs):
    asked = docs.select(F.col("doc_id").alias("query_id"), "text")
    found = search.search(search.index(docs), asked)
    by = {}
    for r in found.collect():
        by.setdefault(r["query_id"], []).append((r["rank"], r["doc_id"]))
    assert set(by) == {1, 5, 6, -7}
    # Ties by id, null first; two texts under one id are one query of all their terms.
    assert [d for _, d in sorted(by[-7])] == [-7]
    assert search.search(search.index(empty_documents(spark)), asked).count() == 0
    assert search.search(search.index(docs), asked.where("query_id = 2")).count() == 0


def test_quality_rules(spark, docs):
    found = quality_rules.score(docs, quality_rules.train(docs, labels(spark)))
    assert ids(found) == ALL
    by = {r["doc_id"]: r for r in found.collect()}
    assert by[2]["n_words"] == by[3]["n_words"] == by[4]["n_words"] == 0 and by[2]["base_failed"] and not by[2]["kept"]
    assert by[5]["n_words"] == 30_000 and by[5]["kept"]
    kept = quality_rules.filter_quality(docs, None)
    assert kept.columns == docs.columns and ids(kept) == [5]
    assert quality_rules.score(empty_documents(spark), None).count() == 0


def test_near_duplicates(spark, docs):
    found = order_minhash.class_ids(docs)
    assert ids(found) == ALL
    prose = found.where("doc_id = 1").collect()
    assert sorted(str(r["class_id"]) for r in prose) == ["1", "None", "None"]
    kept = order_minhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert ids(kept) == [None, None, -7, 1, 2, 3, 4, 5, 6]
    assert order_minhash.class_ids(empty_documents(spark)).count() == 0
    assert order_minhash.keep_one(empty_documents(spark)).count() == 0
