"""Length buckets: assign, pad/cut to the bucket size, report counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.functions.text import (
    DEFAULT_BUCKETS,
    UNSEEN,
    bucket_of,
    pad_to_bucket,
    validated_buckets,
)


def bucket_lengths(df: DataFrame, buckets: Sequence[int] = DEFAULT_BUCKETS,
                   length_col: str = "length") -> DataFrame:
    """Add ``bucket`` and ``sliced`` from a length alone (null length -> null)."""
    bs = validated_buckets(buckets)
    n = F.col(length_col)
    return df.withColumn("bucket", bucket_of(n, bs)).withColumn("sliced", n > F.lit(bs[-1]))


def assign_buckets(
    df: DataFrame,
    seq_col: str = "X",
    buckets: Sequence[int] = DEFAULT_BUCKETS,
    out: str = "P",
    pad_value: int = UNSEEN,
    length_col: str | None = None,
) -> DataFrame:
    """Add ``length``, ``bucket``, ``sliced`` and the padded/cut sequence ``out``.

    Rows with a null sequence get null in all four columns.  ``length_col``
    names an existing column holding the sequence length (for instance the
    size of the characters before indexing), so that counting rows per bucket
    does not need the indexed sequence itself.
    """
    bs = validated_buckets(buckets)
    seq = F.col(seq_col)
    if length_col:
        length = F.col(length_col).cast("int")
    else:
        length = F.when(seq.isNotNull(), F.size(seq)).cast("int")
    return bucket_lengths(df.withColumn("length", length), bs).withColumn(
        out, F.when(seq.isNotNull(), pad_to_bucket(seq_col, "bucket", pad_value)))


def bucket_counts(df: DataFrame, buckets: Sequence[int] = DEFAULT_BUCKETS) -> DataFrame:
    """``(bucket, n)`` for every bucket size, 0 for empty buckets.

    One conditional count per bucket size in a single aggregate, then an
    unpivot.  There is deliberately no filter or join on the derived ``bucket``
    column: Catalyst would push the implied ``bucket IS NOT NULL`` below the
    projections and evaluate the whole sequence expression again inside it.
    """
    bs = validated_buckets(buckets)
    b = F.col("bucket")
    wide = df.agg(*[
        F.coalesce(F.sum(F.when(b == F.lit(size), F.lit(1)).otherwise(F.lit(0))), F.lit(0))
        .cast("long").alias(f"n{size}")
        for size in bs
    ])
    long = wide.unpivot([], [f"n{size}" for size in bs], "_name", "n")
    return long.select(
        F.substring(F.col("_name"), 2, 10).cast("int").alias("bucket"),
        F.col("n").cast("long").alias("n"),
    )


def sliced_count(df: DataFrame) -> DataFrame:
    """Number of rows cut to the largest bucket."""
    return df.agg(
        F.coalesce(F.sum(F.col("sliced").cast("long")), F.lit(0)).alias("n_sliced")
    )
