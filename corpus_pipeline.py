"""Corpus pipeline: toxicity, near duplicates, repeated passages, benchmark
leaks, packing.  Each stage works on all rows that the one before it kept.

Null and repeated rows, empty tables and extra columns are handled as each
operator states; all stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cataloom.llm import decontaminate, packing, simhash, suffix_dedup, toxicity
from cataloom.llm.queries import table, tokenizer_path
from cataloom.session import shared_path


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that score below the toxicity threshold."""
    return toxicity.keep_clean(docs, table(spark, sf_dir, "labels"))


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component."""
    return simhash.keep_first(docs)


def cut_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without bytes of passages that start earlier too."""
    return suffix_dedup.remove_repeats(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark window."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Placement of every piece of the remaining documents."""
    return packing.pack_documents(docs, tokenizer_path())


STAGES = [
    ("toxicity", drop_toxic),
    ("simhash", drop_near_duplicates),
    ("suffix_dedup", cut_repeats),
    ("decontamination", drop_leaks),
    ("packing", pack),
]

#: Learned scores, hashes and tokenizers: SQL cannot express the stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on ``documents``, each written as Parquet and read again."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES:
        path = shared_path(spark, "pipeline", name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
