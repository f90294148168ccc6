"""From raw documents to packed training sequences, in five stages.

Documents that break the quality rules go; lines that are boilerplate of their source go; one
document of each group of near duplicates stays; sources are mixed to their target weights, documents
repeating as often as the mix takes them; the mix is packed into sequences of 4096 tokens.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from demandloom.llm import jaccard_join, line_dedup, mixing, packing, quality_rules
from demandloom.llm.store import tidily_written as written


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return quality_rules.keep_good(docs)


def line_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return line_dedup.drop_lines(docs)


def near_duplicate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return jaccard_join.one_of_each(docs)


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mixed(docs)


def packing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack_documents(docs)


STAGES = [
    ("quality_rules", quality_stage),
    ("line_dedup", line_stage),
    ("ngram_jaccard_join", near_duplicate_stage),
    ("source_mixing", mixing_stage),
    ("best_fit_packing", packing_stage),
]

#: Verification of near duplicates and tokenization have no SQL form; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each is written as Parquet and read by the next."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir), name)
    return STAGES[-1][1](spark, docs, sf_dir)
