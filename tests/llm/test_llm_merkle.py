"""The manifest against SQL (op12), a tree built in plain Python, and odd rows."""

import hashlib
import zlib

import duckdb
import pytest
from odd_rows import empty_documents, odd_documents
from pyspark.sql import functions as F

from fleetpulse.llm import merkle, queries

SF = "/root/testdata/sf0.01"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    fields = [r["doc_id"], r["source"], r["lang"], r["n_chars"], text]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in fields])


def plain_tree(leaves):
    """(top, path of each leaf)."""
    paths, place, nodes = [[] for _ in leaves], list(range(len(leaves))), list(leaves)
    while len(nodes) > 1:
        runs = [nodes[i : i + 8] for i in range(0, len(nodes), 8)]
        for leaf, at in enumerate(place):
            run = runs[at // 8]
            paths[leaf].append(("".join(run[: at % 8]), "".join(run[at % 8 + 1 :])))
        nodes, place = [h(*run) for run in runs], [at // 8 for at in place]
    return nodes[0], paths


def plain_manifest(rows):
    by = {}
    for r in rows:
        by.setdefault(r["lang"], []).append(r)
    langs = sorted(by, key=lambda v: (v is not None, (v or "").encode()))
    trees = {}
    for lang in langs:
        by[lang].sort(key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0, plain_leaf(r, r["text"])))
        trees[lang] = plain_tree([plain_leaf(r, r["text"]) for r in by[lang]])
    root, over = plain_tree([trees[lang][0] for lang in langs])
    out = []
    for lang, above in zip(langs, over):
        for r, path in zip(by[lang], trees[lang][1]):
            path = path + above
            changed = r["doc_id"] is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0
            text = r["text"]
            if changed and text is not None:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            node = plain_leaf(r, text)
            for left, right in path:
                node = h(left, node, right)
            proof = h(*[x for level in path for x in level])
            out.append((r["doc_id"], plain_leaf(r, r["text"]), trees[lang][0], root, proof, node, node == root))
    return sorted(out, key=repr)


def run(docs):
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.verify(docs, tampered=tampered, text=merkle.lower_ascii(F.col("text")))


@pytest.mark.parametrize("count", [1, 65, 600])
def test_trees_of_every_shape(spark, count):
    docs = spark.range(count).select(
        (F.col("id") * 37 % 1009).alias("doc_id"),
        F.concat(F.lit("Text É "), F.col("id")).alias("text"),
        F.when(F.col("id") % 11 == 10, None).when(F.col("id") % 5 == 0, "de").otherwise("en").alias("lang"),
        F.when(F.col("id") % 4 != 0, "s").alias("source"),
        (F.col("id") % 3).alias("n_chars"),
    )
    got = sorted((tuple(r) for r in run(docs).collect()), key=repr)
    assert got == plain_manifest(docs.collect())


def test_many_languages(spark):
    docs = spark.range(150).select(
        F.col("id").alias("doc_id"), F.lit("Aa").alias("text"), F.concat(F.lit("l"), F.col("id") % 70).alias("lang"),
        F.lit("s").alias("source"), F.lit(2).alias("n_chars"),
    )
    assert sorted((tuple(r) for r in run(docs).collect()), key=repr) == plain_manifest(docs.collect())


def test_op12_equals_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{SF}/documents.parquet'")
    got = queries.op12_merkle_manifest(spark, SF)
    expected = con.execute(queries.OP12_SQL)
    assert got.columns == [c[0] for c in expected.description]
    assert sorted(tuple(r) for r in got.collect()) == sorted(expected.fetchall())


def test_one_changed_byte_changes_the_root(spark):
    docs = spark.createDataFrame([(i, f"text {i}", "en", "s", 6) for i in range(20)], "doc_id long, text string, lang string, source string, n_chars long")
    roots = {run(docs).first()["root"]}
    for column in ("text", "source", "lang"):
        changed = F.when(F.col("doc_id") == 7, F.concat(column, F.lit("x"))).otherwise(F.col(column))
        roots.add(run(docs.withColumn(column, changed)).first()["root"])
    assert len(roots) == 4


def test_odd_rows(spark):
    docs = odd_documents(spark)
    assert sorted((tuple(r) for r in run(docs).collect()), key=repr) == plain_manifest(docs.collect())
    empty = run(empty_documents(spark))
    assert empty.count() == 0 and len(empty.columns) == 7


def test_slot_zero_rows_are_joined_by_computed_indices(spark):
    nodes = spark.range(100).select(F.concat(F.lit("=l"), F.col("id") % 2).alias("branch"), F.col("id").alias("idx"), F.struct(F.lit("x").alias("hash")).alias("node"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = merkle._runs(nodes, 8)._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert text.count("SortMergeJoin") == 7 and "Python" not in text
    # Every node is shuffled once: the joined rows stay where they are.
    assert text.count("Exchange hashpartitioning(branch") == 8
