"""The corpus pipeline: select by quality, keep one of each near-duplicate group, take out benchmark leaks, redact secrets, pack.

Every stage works on all documents that the one before kept, is written as Parquet in the shared folder and read again; all but the last
return the columns of `documents`.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from arraytide.llm import common, decontaminate, jaccard, packing, quality, secrets
from arraytide.llm.queries import graded, table, tokenizer


def select_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the ordinal classifier expects to be of the highest grade."""
    return quality.selected(docs, graded(spark, sf_dir), names=("_grade", "_tails")).select(*docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of 5-word-shingle Jaccard 0.8 and more: that with the smallest id."""
    return jaccard.one_of_each(docs, k=5, num=80)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_leaks(docs, table(spark, sf_dir, "benchmark"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with their secrets replaced."""
    return secrets.redact(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of all documents in sequences of 2048 tokens."""
    return packing.pack(docs, tokenizer("byte_bpe_50k.json"))


STAGES = [
    ("quality_classifier", select_quality),
    ("ngram_jaccard_join", drop_near_duplicates),
    ("benchmark_decontamination", drop_leaks),
    ("secret_scans", redact_secrets),
    ("best_fit_packing", pack_sequences),
]

# a fitted classifier and a BPE tokenizer are beyond SQL: tests/llm holds the pipeline against a brute-force version
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = common.stored(stage(spark, docs, sf_dir), name)
    return common.stored(STAGES[-1][1](spark, docs, sf_dir), STAGES[-1][0])
