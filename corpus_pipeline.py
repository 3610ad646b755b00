"""The corpus pipeline: five operators one after another over ``documents``.

Each stage takes (spark, docs, sf_dir) and works on all rows that the stage before it
kept; ``run`` writes every stage's rows to the shared folder and reads them again.  All
stages but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from framewright.llm import decontaminate, fertility, line_dedup, piece_lattice, simhash_vptree, store
from framewright.llm.queries import vocabulary


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents that the base rules or the fertility bands reject."""
    return fertility.keep_good(docs, vocabulary("piece_bpe_32k.model"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts repeated lines out of texts; documents left without a word go."""
    return line_dedup.keep_lines(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of every component of texts at 5-word shingle similarity 0.8."""
    return simhash_vptree.keep_one(docs, shingle=5, similarity=0.8)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops documents with a benchmark passage."""
    return decontaminate.keep_clean(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def encoding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Best segmentation of each text, with its ids, and the figures of the n best."""
    return piece_lattice.segment(docs, vocabulary("piece_bpe_32k.model"), with_ids=True)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup_stage),
    ("simhash_near_dedup", near_dedup),
    ("benchmark_decontamination", decontamination),
    ("sentencepiece", encoding),
]

#: SQL has no tokeniser and no lattice search; tests hold each stage against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = store.cut(stage(spark, docs, sf_dir), name)
    return docs
