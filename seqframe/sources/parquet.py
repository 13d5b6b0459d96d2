"""Parquet input: prepared frames and vocabularies written by ``sinks``."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from seqframe.operators.vocab import VOCAB_SCHEMA


def read_frame(spark: SparkSession, path: str) -> DataFrame:
    """A prepared frame (``row_id``, labels, ``X``, ``Y``, ...)."""
    return spark.read.parquet(path)


def read_vocab(spark: SparkSession, path: str) -> DataFrame:
    """A vocabulary ``(idx INT, term STRING, n BIGINT)``."""
    return spark.read.schema(VOCAB_SCHEMA).parquet(path)
