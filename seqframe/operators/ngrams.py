"""Exact n-gram features: a fitted dictionary gives every n-gram a place of its own.

``features.py`` hashes n-grams into a fixed number of slots, so unlike n-grams share one.  Here the width
follows the data: the distinct n-grams of the training rows, those in at least ``min_df`` of them, are
numbered densely (``dense_index``), and rows get the numbers of their n-grams by a join.

A gram is looked up by broadcast while the dictionary's counted size allows it.  Beyond that the grams
with the highest document frequency are broadcast (they are the join's hot keys: every padded row
holds the pad grams) and only the rest is shuffled; the rows with their first answers are written once.

Null or short token lists have no n-grams of that length.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml.feature import HashingTF
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from seqframe.operators.features import DEFAULT_HASH_SLOTS, DEFAULT_NGRAMS
from seqframe.operators.numbering import dense_index
from seqframe.session import scratch_dir, store_table

#: A table is broadcast whole up to so many rows and bytes of keys, else its heaviest rows are.
BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 128 << 20
HEAVY_ROWS = 100_000


def grams(tokens: Column, n: int) -> Column:
    """Distinct runs of ``n`` tokens, joined by spaces."""
    runs = F.transform(F.sequence(F.lit(1), F.size(tokens) - (n - 1)),
                       lambda i: F.array_join(F.slice(tokens, i, n), " "))
    return F.when(F.size(tokens) >= n, F.array_distinct(runs)).otherwise(F.array().cast("array<string>"))


def gram_rows(df: DataFrame, tokens_col: str = "T", row_col: str = "row_id",
              ns: Sequence[int] = DEFAULT_NGRAMS) -> DataFrame:
    """``row_id, n, gram``: each distinct n-gram of a row once."""
    each = F.array(*[F.struct(F.lit(n).alias("n"), grams(F.col(tokens_col), n).alias("g")) for n in ns])
    return df.select(row_col, F.explode(each).alias("_e")).select(
        row_col, F.col("_e.n").alias("n"), F.explode("_e.g").alias("gram"))


def gram_dictionary(rows: DataFrame, min_df: int = 1) -> DataFrame:
    """``idx, n, gram, df`` of ``gram_rows``: by length, then document frequency, then the gram."""
    counts = rows.groupBy("n", "gram").agg(F.count(F.lit(1)).alias("df")).where(F.col("df") >= min_df)
    return dense_index(counts, [F.col("n"), F.col("df").desc(), F.col("gram")], out="idx").select(
        F.col("idx").cast("long").alias("idx"), "n", "gram", "df")


def lookup(rows: DataFrame, table: DataFrame, keys: Sequence[str], weight: str,
           max_rows: int = BROADCAST_ROWS, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``rows`` joined with the unique ``keys`` of ``table``; ``weight`` tells its commonest keys."""
    width = sum(F.octet_length(F.col(k).cast("string")) for k in keys)
    count, size = table.agg(F.count(F.lit(1)), F.sum(width)).first()
    keys = list(keys)
    if count <= max_rows and (size or 0) <= BROADCAST_BYTES:
        return rows.join(F.broadcast(table.drop(weight)), keys)
    answers = [c for c in table.columns if c not in (*keys, weight)]
    short = table.where(width <= 1024)  # bounds the broadcast's bytes as well
    heavy = short.orderBy(F.col(weight).desc(), *keys).limit(heavy_rows).drop(weight).withColumn(
        "_hit", F.lit(True))
    first = store_table(rows.join(F.broadcast(heavy), keys, "left"), "looked-up")
    rest = first.where("_hit is null").drop("_hit", *answers).join(table.drop(weight), keys)
    return first.where("_hit").drop("_hit").select(*rest.columns).unionByName(rest)


def index_grams(rows: DataFrame, dictionary: DataFrame, **bounds: int) -> DataFrame:
    """``rows`` with ``idx``; n-grams outside the dictionary are left out."""
    return lookup(rows, dictionary.select("n", "gram", "idx", "df"), ["n", "gram"], "df", **bounds)


def gram_indices(indexed: DataFrame, by: Sequence[str] = ("row_id",)) -> DataFrame:
    """One row per ``by`` with the ascending ``indices`` of its n-grams."""
    return indexed.groupBy(*by).agg(F.sort_array(F.collect_list("idx")).alias("indices"))


def sparse_vectors(df: DataFrame, size: int, indices_col: str = "indices", out: str = "features") -> DataFrame:
    """Binary sparse vectors of ``size`` for ``pyspark.ml`` in place of index lists (null: none).

    A vector column is stored as a struct, so the table is written with the struct and read with the
    vector type: no row passes through Python.
    """
    at = F.coalesce(F.col(indices_col).cast("array<int>"), F.array().cast("array<int>"))
    vector = F.struct(F.lit(0).cast("byte").alias("type"), F.lit(size).alias("size"), at.alias("indices"),
                      F.transform(at, lambda _: F.lit(1.0)).alias("values"))
    table = df.drop(indices_col)
    path = scratch_dir(df.sparkSession, "vectors")
    df.withColumn(out, vector).select(*table.columns, out).write.parquet(path)
    schema = StructType([*table.schema.fields, StructField(out, VectorUDT())])
    return df.sparkSession.read.schema(schema).parquet(path)


def collision_share(dictionary: DataFrame, slots: int = DEFAULT_HASH_SLOTS) -> DataFrame:
    """Per length: distinct n-grams, slots they take when hashed, and the share that has no slot alone."""
    hashed = HashingTF(inputCol="_g", outputCol="_v", numFeatures=slots, binary=True).transform(
        dictionary.select("n", F.array("gram").alias("_g")))
    slot = hashed.select("n", F.col("_v").cast("string").alias("slot"))
    per = slot.groupBy("n", "slot").agg(F.count(F.lit(1)).alias("c"))
    return per.groupBy("n").agg(
        F.sum("c").alias("n_grams"), F.count(F.lit(1)).alias("n_slots"),
        (F.sum(F.when(F.col("c") > 1, F.col("c")).otherwise(0)) / F.sum("c")).alias("share"))
