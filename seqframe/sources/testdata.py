"""The driver's parquet tables, and the article frame the test data stands in for.

``documents.text`` plays the article description, ``doc_id`` the row id and
``lang`` the four-class label (as codes 1-4, so the code -> name map applies).
The train/test split is an md5 of a seed and the row id: reproducible and
independent of how the data is partitioned.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

# Stand-in label codes of the test data's languages.
LANG_CODES = {"en": 1, "fr": 2, "de": 3, "es": 4}
SPLIT_SEED = 7
TEST_FRACTION = 0.2


# Session setting: spread each table over at least this many partitions right
# after the scan.  Only for inputs stored as a few large row groups (the local
# test files are one row group each, so one task would do all the text work);
# a cluster reading many files leaves it unset and pays no extra shuffle.
MIN_INPUT_PARTITIONS = "spark.seqframe.input.minPartitions"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    wanted = spark.conf.get(MIN_INPUT_PARTITIONS, None)
    if wanted and int(wanted) > df.rdd.getNumPartitions():
        df = df.repartition(int(wanted))
    return df


def lang_code(lang: Column | str) -> Column:
    c = F.col(lang) if isinstance(lang, str) else lang
    expr = None
    for k, v in LANG_CODES.items():
        expr = F.when(c == k, F.lit(v)) if expr is None else expr.when(c == k, F.lit(v))
    return expr.cast("int")


def split_threshold(test_fraction: float = TEST_FRACTION) -> str:
    """8 hex digits; a row is test when its split key sorts below this."""
    return format(int(test_fraction * 16**8), "08x")


def split_of(row_id: Column | str, seed: int = SPLIT_SEED,
             test_fraction: float = TEST_FRACTION) -> Column:
    r = F.col(row_id) if isinstance(row_id, str) else row_id
    key = F.substring(F.md5(F.concat_ws("|", F.lit("split"), F.lit(str(seed)), r.cast("string"))), 1, 8)
    return F.when(key < F.lit(split_threshold(test_fraction)), F.lit("test")).otherwise(F.lit("train"))


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(row_id, indexed_label, description, split)`` from ``documents``."""
    docs = table(spark, sf_dir, "documents")
    return docs.select(
        F.col("doc_id").alias("row_id"),
        lang_code("lang").alias("indexed_label"),
        F.col("text").alias("description"),
        split_of("doc_id").alias("split"),
    )


def train_test(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    a = articles(spark, sf_dir)
    return a.where(F.col("split") == "train"), a.where(F.col("split") == "test")
