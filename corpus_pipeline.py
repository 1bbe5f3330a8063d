"""Corpus pipeline: STAGES over documents, each stage's output written and read as the next one's input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidemark.llm import decontam, mixing, quality, simhash, tokens
from tidemark.llm.common import cut
from tidemark.llm.queries import table, tokenizer


def quality_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality rules keep; the rules are learned from labels and these documents."""
    return quality.keep_good(docs, table(spark, sf_dir, "labels"))


def dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document, the one of the smallest id, of each group of near duplicates.

    Links are op8's, fingerprints within its radius by tiles, and those of a five-word similarity of 0.8 or more.
    """
    return simhash.keep_near(docs)


def decontamination_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a benchmark item."""
    return decontam.clean(docs, table(spark, sf_dir, "benchmark"))


def mixing_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix of its source takes it."""
    return mixing.resample(docs)


def token_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The token files' content, one row a document and copy."""
    return tokens.token_output(docs, tokenizer())


STAGES = [
    ("quality rules", quality_stage),
    ("SimHash near-dedup", dedup_stage),
    ("benchmark decontamination", decontamination_stage),
    ("mixing sources to target weights", mixing_stage),
    ("token-ID / binary output", token_stage),
]

#: No SQL: the stages learn, hash and encode; tests/llm holds them against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over sf_dir's documents."""
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES[:-1]):
        docs = cut(stage(spark, docs, sf_dir), f"stage-{k}")
    return STAGES[-1][1](spark, docs, sf_dir)
