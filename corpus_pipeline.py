"""From raw documents to packed training sequences: each stage works on what the one before it kept.

STAGES are run one after the other, each on the written result of the last. All but the last return the columns of
documents; the last returns a row per piece with its place in a sequence. What a stage stores on the way is deleted when
its result is written.

Nulls in any column, empty and very long texts, repeated rows and extra columns of any name: as in the operators. Documents
without words are rejected by the quality rules; where a later stage is given some, line dedup and near-dedup leave them,
each a class of its own by its text, the mix takes them as often as their neighbours and packing gives each a piece of one
token. Without labels the quality rules keep all that pass the base rules. An empty table gives an empty result at every
stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fleetpulse.llm import line_dedup, mixing, order_minhash, packing, quality_rules
from fleetpulse.llm.common import stored_alone, table


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the classifier learns from all labelled documents."""
    model = quality_rules.train(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return quality_rules.filter_quality(docs, model)


def lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the blocks of lines that earlier ones have; those with nothing of their own left go."""
    done = line_dedup.dedup_lines(docs)
    changed = F.col("deleted_lines") > 0
    return (
        done.where(~changed | F.col("text").rlike(r"[^\x20\x09-\x0D]"))
        .withColumn("n_chars", F.when(changed, F.char_length("text").cast("long")).otherwise(F.col("n_chars")))
        .select(*docs.columns)
    )


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies."""
    return order_minhash.keep_one(docs)


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents as often as the mix of sources takes them."""
    return mixing.mixed(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents and where they lie."""
    packed = packing.pack_documents(docs, packing.word_tokenizer())
    return packed.select("doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset")


STAGES = [
    ("quality_rules", quality),
    ("line_dedup", lines),
    ("near_dedup", near_duplicates),
    ("mix_sources", mix),
    ("best_fit_packing", pack),
]

# Classifier, tokenizer and alignment have no SQL: the tests hold each stage against a plain version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = stored_alone(lambda given=docs, stage=stage: stage(spark, given, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
