"""One query per operator, over whole tables, and SQL where it can say the same."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import licenses, line_dedup, merkle, mixing, order_minhash, packing, quality_rules, search, site_quality, toxicity, warc, whitening, winnowing
from fleetpulse.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return licenses.scan(documents, licenses.train(documents))


def op2_site_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    # A document's source is its host, the languages of a source are its paths.
    return site_quality.judge_by(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    return toxicity.score(documents, toxicity.train(documents, table(spark, sf_dir, "labels")))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_dedup.dedup_lines(table(spark, sf_dir, "documents")).select("doc_id", "deleted_lines", "text")


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    packed = packing.pack_documents(table(spark, sf_dir, "documents"), packing.word_tokenizer())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


def op6_mix_sources(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, plan = mixing.mix(table(spark, sf_dir, "documents"))
    sources = spark.createDataFrame(
        [(s, size, target) for s, (size, target) in plan.sources.items()], "source string, source_size long, target double"
    )
    rows = rows.withColumn("_source", F.col("sources")[0]).join(
        F.broadcast(sources), F.col("_source").eqNullSafe(F.col("source"))
    )
    return rows.select("doc_id", "size", "source_size", "target", "taken", "source")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    folder = warc.archive_folder(spark)
    warc.write_archives(table(spark, sf_dir, "pages"), folder)
    return warc.captures(spark, folder, blocks=False).select(
        "page_id", "response.payload_bytes", "response.payload_digest", "response.record_type",
        F.col("refers_to_page").alias("refers_to"),
    )


OP7_SQL = """
WITH page AS (SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
     held AS (SELECT html, max(page_id) AS last FROM page WHERE n >= 1000 GROUP BY html)
SELECT p.page_id, CAST(p.n AS BIGINT) AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN h.html IS NOT NULL AND p.page_id IS DISTINCT FROM h.last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN p.page_id IS DISTINCT FROM h.last THEN h.last END AS refers_to
FROM page p LEFT JOIN held h ON p.html = h.html
"""


def op8_bm25_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    queries = documents.where(search.every_twentieth(F.col("doc_id"))).select(F.col("doc_id").alias("query_id"), "text")
    return search.search(search.index(documents), queries)


def op9_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "documents")
    model = quality_rules.train(documents, table(spark, sf_dir, "labels"))
    return quality_rules.score(documents, model)


def op10_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_minhash.class_ids(table(spark, sf_dir, "documents"))


def op11_embedding_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    tampered = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    return merkle.verify(table(spark, sf_dir, "documents"), tampered=tampered, text=merkle.lower_ascii(F.col("text")))


def _climb_sql(name: str, leaves: str) -> str:
    """All nodes of the trees over leaves (b, idx, h), the level of each tree's top, and every node's siblings."""
    return f"""
{name} AS (
  SELECT b, 0 AS lvl, idx, h FROM {leaves}
  UNION ALL
  SELECT b, lvl + 1, idx // 8, sha256(string_agg(h, '' ORDER BY idx))
  FROM (SELECT *, count(*) OVER (PARTITION BY b) AS n FROM {name}) WHERE n > 1 GROUP BY b, lvl, idx // 8),
{name}_top AS (SELECT b, lvl, h FROM {name} QUALIFY row_number() OVER (PARTITION BY b ORDER BY lvl DESC) = 1),
{name}_sides AS (
  SELECT n.b, n.lvl, n.idx, coalesce(string_agg(m.h, '' ORDER BY m.idx) FILTER (m.idx < n.idx), '') AS l,
         coalesce(string_agg(m.h, '' ORDER BY m.idx) FILTER (m.idx > n.idx), '') AS r
  FROM {name} n JOIN {name}_top t ON t.b = n.b AND n.lvl < t.lvl
  JOIN {name} m ON m.b = n.b AND m.lvl = n.lvl AND m.idx // 8 = n.idx // 8
  GROUP BY n.b, n.lvl, n.idx)"""


def _fold_sql(name: str, tree: str, start: str) -> str:
    """Hash and siblings so far of every row of start (seq, b, idx, h, p) at the top of its tree."""
    return f"""
{name} AS (
  SELECT seq, b, 0 AS lvl, idx, h, p FROM {start}
  UNION ALL
  SELECT f.seq, f.b, f.lvl + 1, f.idx // 8, sha256(s.l || f.h || s.r), f.p || s.l || s.r
  FROM {name} f JOIN {tree}_sides s ON s.b = f.b AND s.lvl = f.lvl AND s.idx = f.idx)"""


def _field_sql(value: str) -> str:
    return f"coalesce(strlen(CAST({value} AS VARCHAR)) || ':' || CAST({value} AS VARCHAR), '-')"


def _leaf_sql(text: str) -> str:
    return f"sha256({' || '.join(map(_field_sql, ('doc_id', 'source', 'lang', 'n_chars', text)))})"


_CRC_SQL = """xor(4294967295, list_reduce(
    list_prepend(4294967295::BIGINT, list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: ascii(c)::BIGINT)),
    lambda crc, byte: list_reduce(list_prepend(xor(crc, byte), range(8)), lambda x, i: xor(x >> 1, 3988292384 * (x & 1)))))"""

OP12_SQL = f"""
WITH RECURSIVE doc AS (
  SELECT doc_id, coalesce('=' || lang, '') AS b, {_leaf_sql('text')} AS h,
         CASE WHEN {_CRC_SQL} % 3 = 0
              THEN {_leaf_sql("translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')")} END AS changed
  FROM documents),
leaves AS (
  SELECT *, row_number() OVER (ORDER BY b, doc_id NULLS FIRST, h) AS seq, '' AS p,
         row_number() OVER (PARTITION BY b ORDER BY doc_id NULLS FIRST, h) - 1 AS idx FROM doc),
{_climb_sql('tree', 'leaves')},
langs AS (SELECT b AS lang, '' AS b, row_number() OVER (ORDER BY b) - 1 AS idx, h FROM tree_top),
{_climb_sql('whole', 'langs')},
given AS (SELECT seq, b, idx, coalesce(changed, h) AS h, p FROM leaves),
{_fold_sql('climbed', 'tree', 'given')},
over AS (
  SELECT c.seq, l.b, l.idx, c.h, c.p FROM climbed c JOIN tree_top t ON t.b = c.b AND t.lvl = c.lvl JOIN langs l ON l.lang = c.b),
{_fold_sql('done', 'whole', 'over')}
SELECT v.doc_id, v.h AS leaf, t.h AS subroot, w.h AS root, sha256(d.p) AS proof_sha256, d.h AS folded_root,
       d.h = w.h AS verified
FROM done d JOIN whole_top w ON w.lvl = d.lvl JOIN leaves v ON v.seq = d.seq JOIN tree_top t ON t.b = v.b
"""


def op13_winnowing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return winnowing.compare_next(table(spark, sf_dir, "documents"))


QUERIES: dict[str, Query] = {
    f.__name__: f
    for f in (
        op1_license_scan,
        op2_site_quality,
        op3_toxicity,
        op4_line_dedup,
        op5_best_fit_packing,
        op6_mix_sources,
        op7_warc,
        op8_bm25_search,
        op9_quality_rules,
        op10_order_minhash,
        op11_embedding_whitening,
        op12_merkle_manifest,
        op13_winnowing,
    )
}
ORACLES: dict[str, str] = {"op7_warc": OP7_SQL, "op12_merkle_manifest": OP12_SQL}
