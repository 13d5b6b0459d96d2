"""Small helpers shared by the training-data operators."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.session import scratch_dir
from seqframe.sources.testdata import table

#: Words are runs of anything but ASCII white space (contract of several operators).
SPACE_WORD = r"[^\x20\x09-\x0D]+"

#: Rows that one hash slice should hold at most; slices are sorted in one task each.
SLICE_ROWS = 1 << 17
MIN_SLICES = 256

DOCUMENT_COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return table(spark, sf_dir, name)


def n_words(text: Column) -> Column:
    """Number of white-space words; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACE_WORD)), F.lit(0)).cast("long")


def slices_for(n_rows: int) -> int:
    """A power of two, so that an evenly hashed slice of a group of n_rows fits a task."""
    return max(MIN_SLICES, 1 << max(0, math.ceil(math.log2(max(1, n_rows / SLICE_ROWS)))))


def source_key(source: Column) -> Column:
    """A join and group key that keeps null apart from every text, so nulls join."""
    return F.when(source.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), source))


def store(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` to a new parquet table in the checkpoint folder and read it back.

    Cuts the lineage like ``checkpoint()``, but compressed and with column pruning for
    later readers.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
