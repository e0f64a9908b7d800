"""Each stage of the pipeline works on what the one before it kept, and its decisions take effect."""

import collections
from pathlib import Path

import pytest
from odd_rows import empty_documents, labels, odd_documents
from pyspark.sql import functions as F

import corpus_pipeline
from fleetpulse.llm import quality_rules
from fleetpulse.llm.common import stored, stored_alone, table
from fleetpulse.llm.line_dedup import MIN_BLOCK_WORDS
from test_llm_operators import WORD, near_classes

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def stages(spark):
    docs, out = table(spark, SF, "documents"), []
    for name, stage in corpus_pipeline.STAGES:
        result = stored(stage(spark, docs, SF), name)
        out.append((name, docs, result))
        docs = result
    return out


def texts(df):
    return {r["doc_id"]: r["text"] for r in df.select("doc_id", "text").collect()}


def test_names_and_columns(stages):
    assert [n for n, _, _ in stages] == ["quality_rules", "line_dedup", "near_dedup", "mix_sources", "best_fit_packing"]
    for _, _, result in stages[:-1]:
        assert result.columns == ["doc_id", "text", "lang", "source", "n_chars"]


def test_quality(spark, stages):
    _, before, after = stages[0]
    model = quality_rules.train(before, table(spark, SF, "labels"))
    kept = {r["doc_id"] for r in quality_rules.score(before, model).where("kept").collect()}
    assert texts(after) == {i: t for i, t in texts(before).items() if i in kept}


def test_lines(stages):
    _, before, after = stages[1]
    left, held = texts(after), set()
    for i, text in sorted(texts(before).items()):
        long = [line for line in text.split("\n") if len(WORD.findall(line)) >= MIN_BLOCK_WORDS]
        kept = left.get(i, "").split("\n")
        assert all((line in kept) == (line not in held) for line in long)
        held.update(long)
    assert after.where(F.col("n_chars") != F.char_length("text")).count() == before.where(F.col("n_chars") != F.char_length("text")).count()


def test_near_duplicates(stages):
    _, before, after = stages[2]
    classes = near_classes(texts(before))
    assert set(texts(after)) == set(classes.values())


def test_mix(stages):
    _, before, after = stages[3]
    size = {i: len(WORD.findall(t)) for i, t in texts(before).items()}
    times = collections.Counter(r["doc_id"] for r in after.select("doc_id").collect())
    assert max(times.values()) <= 2 and times.keys() <= size.keys()
    assert sum(n * size[i] for i, n in times.items()) == pytest.approx(1.5 * sum(size.values()), rel=0.01)


def test_packing(stages):
    _, before, after = stages[4]
    assert after.where("piece = 0").count() == before.count()
    assert after.groupBy("sequence_id").agg(F.sum("length").alias("n")).where("n > 4096").count() == 0


def test_run(spark, stages):
    result = corpus_pipeline.run(spark, SF)
    assert result.columns == stages[-1][2].columns and result.count() == stages[-1][2].count()


def odd_folder(spark, path, docs):
    docs.write.parquet(f"{path}/documents.parquet")
    labels(spark).write.parquet(f"{path}/labels.parquet")
    return str(path)


def test_stages_take_odd_rows_without_labels(spark, tmp_path):
    docs = odd_documents(spark)
    folder = odd_folder(spark, tmp_path, docs)
    given = {r["text"] for r in docs.collect()}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        result = stage(spark, docs, folder)
        assert result.columns == docs.columns, name
        times = collections.Counter((r["doc_id"], r["text"]) for r in result.collect())
        kept = {text for _, text in times}
        if name == "quality_rules":
            # No labels: what passes the base rules.
            assert {i for i, _ in times} == {5}
        elif name == "mix_sources":
            assert kept <= given and max(n for (i, _), n in times.items() if i != 1) <= 2
        else:
            assert kept == given, name
    packed = corpus_pipeline.pack(spark, docs, folder)
    assert packed.where("piece = 0").count() == docs.count()
    # The whole of it.
    pieces = corpus_pipeline.run(spark, folder)
    assert {r["doc_id"] for r in pieces.collect()} <= {5}


def test_stages_take_an_empty_table(spark, tmp_path):
    folder = odd_folder(spark, tmp_path, empty_documents(spark))
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, empty_documents(spark), folder).count() == 0, name
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_what_a_stage_stores_on_the_way_is_deleted(spark):
    kept = stored_alone(lambda: stored(stored(spark.range(5).toDF("n"), "a").selectExpr("n + 1 as n"), "b"), "c")
    assert sorted(r[0] for r in kept.collect()) == [1, 2, 3, 4, 5]
    folder = Path(kept.inputFiles()[0].removeprefix("file:")).parents[1]
    assert not list(folder.glob("a-*")) and not list(folder.glob("b-*"))
