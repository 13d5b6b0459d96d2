"""Corpus pipeline: rules, near duplicates, benchmark leaks, source mix, shards.

Every stage takes ``(spark, docs, sf_dir)`` with the columns of ``documents`` and works on all rows
its predecessor kept; its result is written as Parquet and read again as the next stage's ``docs``.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqframe.llm import decontam, mixing, neardup, quality, sharding
from seqframe.llm.common import DOCUMENT_COLUMNS, read, store


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that fail the base rules or are depleted; cut lines over their host's limit."""
    return quality.filter_documents(docs)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keep the document with the smallest id of every near-duplicate group."""
    return neardup.filter_documents(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drop documents that overlap a benchmark item."""
    return decontam.filter_documents(docs, read(spark, sf_dir, "benchmark"))


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Repeat, cut or leave out documents so that sources meet their target words."""
    return mixing.apply_mix(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Place every row in a shard and slot; the documents' columns come along."""
    return sharding.shard(docs, carry=DOCUMENT_COLUMNS)


STAGES = [
    ("quality rules", quality_rules),
    ("near duplicates", near_duplicates),
    ("decontamination", decontamination),
    ("mixing", mix_sources),
    ("sharding", shards),
]

#: The near-duplicate stage is not expressible in SQL; tests/llm hold a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents")
    for i, (_, stage) in enumerate(STAGES):
        docs = store(stage(spark, docs, sf_dir), f"stage{i}")
    return docs
