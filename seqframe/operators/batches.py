"""Shuffled batches per length bucket, as tables instead of an iterator.

Per epoch, rows of each bucket are put in a random order (an md5 of seed,
epoch and row id: stable across task retries, the same in any engine), cut into
full batches of ``batch_size`` rows, and the remainder of each bucket is left
out.  The batches themselves are then put in a random order across buckets
(``batch_seq``).  Both orders use the salted numbering of
``seqframe.operators.numbering.rank_within``, so a bucket holding most rows
never sits in one task.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BinaryType, StringType

from seqframe.functions.text import DEFAULT_BUCKETS, pad_to_bucket, validated_buckets
from seqframe.operators.buckets import bucket_counts
from seqframe.operators.numbering import (
    TARGET_GROUP_BYTES,
    dense_index,
    group_bounds,
    rank_within,
    salt_chars_for,
)


def shuffle_key(seed: int, epoch: int, *cols: str | Column) -> Column:
    """md5 hex of 'seed|epoch|col...'."""
    parts = [F.lit(str(seed)), F.lit(str(epoch))]
    for c in cols:
        parts.append((F.col(c) if isinstance(c, str) else c).cast("string"))
    return F.md5(F.concat_ws("|", *parts))


def bucket_sizes(df: DataFrame, bucket_col: str = "bucket") -> dict[int, int]:
    """Rows per bucket (at most one row per bucket size reaches the driver)."""
    rows = df.groupBy(bucket_col).count().collect()
    return {int(r[bucket_col]): int(r["count"]) for r in rows if r[bucket_col] is not None}


def carried_bytes(df: DataFrame, cols: Sequence[str]) -> Column:
    """About the bytes of a row's ``cols``: text and binary by their length, arrays by their elements."""
    def size(c: str) -> Column:
        kind = df.schema[c].dataType
        if isinstance(kind, (StringType, BinaryType)):
            return F.octet_length(c)
        if isinstance(kind, ArrayType):
            if isinstance(kind.elementType, (StringType, BinaryType)):
                return F.aggregate(c, F.lit(0).cast("long"),
                                   lambda a, x: a + 8 + F.coalesce(F.octet_length(x), F.lit(0)))
            return F.size(c) * 8
        return F.lit(8)

    total = F.lit(0).cast("long")
    for c in cols:
        total = total + F.when(F.col(c).isNull(), F.lit(0)).otherwise(size(c))
    return total


def _bucket_case(bucket: Column, values: dict[int, int], default: int = 0) -> Column:
    expr = None
    for b, v in sorted(values.items()):
        cond = bucket == F.lit(b)
        expr = F.when(cond, F.lit(v)) if expr is None else expr.when(cond, F.lit(v))
    return F.lit(default) if expr is None else expr.otherwise(F.lit(default))


def batch_rows(
    df: DataFrame,
    batch_size: int,
    seed: int = 42,
    epoch: int = 0,
    bucket_col: str = "bucket",
    row_col: str = "row_id",
    keep: Sequence[str] = (),
    sizes: dict[int, int] | None = None,
    target_group_bytes: int = TARGET_GROUP_BYTES,
) -> DataFrame:
    """``(epoch, bucket, batch, row_id, rank, *keep)`` for rows that land in a full batch.

    The columns of ``keep`` travel through the ranking, so their bytes are summed per bucket
    and a bucket of few long rows is cut as finely as one of many short rows.
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    # Rows without a bucket are dropped by the `kept` lookup after ranking, not
    # by a filter on the derived bucket column (see buckets.bucket_counts).
    frame = df.select(row_col, bucket_col, *keep, shuffle_key(seed, epoch, row_col).alias("_key"))
    if sizes is None:
        sizes = bucket_sizes(frame, bucket_col)
    heaviest = group_bounds(frame, [bucket_col], carried_bytes(frame, keep))[1] if keep else 0
    salt = salt_chars_for(max(sizes.values(), default=0), max_group_bytes=heaviest,
                          target_bytes=target_group_bytes)
    ranked = rank_within(frame, "_key", [bucket_col], out="rank", tiebreak=[row_col],
                         salt_chars=salt)
    # Rows of a bucket that fill whole batches; the rest of the bucket is left out.
    kept = _bucket_case(F.col(bucket_col), {b: (n // batch_size) * batch_size
                                            for b, n in sizes.items()})
    return (
        ranked.where(F.col("rank") < kept)
        .select(
            F.lit(epoch).cast("int").alias("epoch"),
            F.col(bucket_col).cast("int").alias(bucket_col),
            F.floor(F.col("rank") / F.lit(batch_size)).cast("long").alias("batch"),
            row_col,
            F.col("rank").cast("long").alias("rank"),
            *keep,
        )
    )


def batch_order(
    spark: SparkSession,
    sizes: dict[int, int],
    batch_size: int,
    seed: int = 42,
    epoch: int = 0,
    bucket_col: str = "bucket",
) -> DataFrame:
    """``(epoch, bucket, batch, batch_seq)``: a random order of all full batches of an epoch.

    The batches are generated by a distributed ``spark.range`` from the bucket
    sizes, so the ranked rows are not read again.
    """
    return epoch_orders(spark, sizes, batch_size, [epoch], seed, bucket_col)


def epoch_orders(spark: SparkSession, sizes: dict[int, int], batch_size: int, epochs: Sequence[int],
                 seed: int = 42, bucket_col: str = "bucket") -> DataFrame:
    """The batch orders of several epochs, generated and ranked (within each epoch) in one plan."""
    full = {b: n // batch_size for b, n in sorted(sizes.items()) if n // batch_size > 0}
    starts, total = {}, 0
    for b, nb in full.items():
        starts[b] = total
        total += nb
    every = F.array(*[F.lit(e) for e in epochs]).cast("array<int>")
    ids = spark.range(total * len(epochs)).select(
        F.element_at(every, F.expr(f"cast(id div {max(total, 1)} + 1 as int)")).alias("epoch"),
        F.pmod(F.col("id"), F.lit(max(total, 1))).alias("id"))
    g = F.col("id")
    bucket = None
    for b in full:
        end = starts[b] + full[b]
        bucket = F.when(g < end, F.lit(b)) if bucket is None else bucket.when(g < end, F.lit(b))
    bucket = (bucket.otherwise(F.lit(None)) if bucket is not None else F.lit(None)).cast("int")
    batches = ids.select("epoch", bucket.alias(bucket_col), g.alias("_g")).select(
        "epoch",
        bucket_col,
        (F.col("_g") - _bucket_case(F.col(bucket_col), starts)).cast("long").alias("batch"),
    )
    keyed = batches.withColumn(
        "_bkey",
        F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"),
                          F.col(bucket_col).cast("string"), F.col("batch").cast("string"))),
    )
    ranked = rank_within(keyed, "_bkey", ["epoch"], out="batch_seq", tiebreak=[bucket_col, "batch"],
                         salt_chars=salt_chars_for(total))
    return ranked.select("epoch", bucket_col, "batch", F.col("batch_seq").cast("long"))


def epoch_rows(df: DataFrame, batch_size: int, epochs: Sequence[int], seed: int = 42,
               bucket_col: str = "bucket", row_col: str = "row_id", sizes: dict[int, int] | None = None,
               left_out: bool = False) -> DataFrame:
    """``(epoch, bucket, batch, row_id, rank)`` of several epochs in one plan.

    Ids and buckets are read once and repeated by epoch, then ranked within (epoch, bucket) by the key
    that ``batch_rows`` uses, so an epoch's rows equal those of ``batch_rows`` for it.  With
    ``left_out``, the rows that fill no whole batch in their epoch instead (``batch`` is null).
    """
    if batch_size <= 0:
        raise ValueError("batch_size must be positive")
    if sizes is None:
        sizes = bucket_sizes(df, bucket_col)
    every = F.array(*[F.lit(e) for e in epochs]).cast("array<int>")
    frame = df.select(row_col, bucket_col, F.explode(every).alias("epoch")).withColumn(
        "_key", F.md5(F.concat_ws("|", F.lit(str(seed)), F.col("epoch").cast("string"),
                                  F.col(row_col).cast("string"))))
    ranked = rank_within(frame, "_key", ["epoch", bucket_col], out="rank", tiebreak=[row_col],
                         salt_chars=salt_chars_for(max(sizes.values(), default=0)))
    kept = _bucket_case(F.col(bucket_col), {b: (n // batch_size) * batch_size for b, n in sizes.items()})
    whole = F.col("rank") < kept
    batch = F.floor(F.col("rank") / F.lit(batch_size)).cast("long")
    return ranked.where(~whole if left_out else whole).select(
        "epoch", F.col(bucket_col).cast("int").alias(bucket_col),
        (F.lit(None).cast("long") if left_out else batch).alias("batch"), row_col,
        F.col("rank").cast("long").alias("rank"))


def assemble_batches(
    rows: DataFrame,
    order: DataFrame | None = None,
    data_col: str = "X",
    label_col: str = "Y",
    bucket_col: str = "bucket",
    row_col: str = "row_id",
) -> DataFrame:
    """One row per batch: ``X`` (rows x bucket), ``Y``, ``row_ids`` in batch order.

    ``rows`` comes from ``batch_rows``, with ``data_col`` and ``label_col`` joined to
    it.  Sequences are padded or cut to the bucket after grouping, so padding is
    not shuffled.  A batch holds at most ``batch_size`` rows, so collecting it is
    bounded.
    """
    item = F.struct(F.col("rank"), F.col(row_col).alias("r"), F.col(data_col).alias("x"),
                    F.col(label_col).alias("y"))
    grouped = rows.groupBy("epoch", bucket_col, "batch").agg(
        F.array_sort(F.collect_list(item)).alias("_items")
    )
    out = grouped.select(
        "epoch",
        bucket_col,
        "batch",
        F.size("_items").alias("n_rows"),
        F.col(bucket_col).alias("seq_len"),
        F.transform("_items", lambda i: pad_to_bucket(i["x"], bucket_col)).alias("X"),
        F.transform("_items", lambda i: i["y"]).alias("Y"),
        F.transform("_items", lambda i: i["r"]).alias("row_ids"),
    )
    if order is not None:
        # `grouped` is already hash-partitioned on these keys, so only the
        # small order table moves.
        out = out.join(order, on=["epoch", bucket_col, "batch"], how="inner")
    return out


def default_bucket_key(buckets: Sequence[int] = DEFAULT_BUCKETS) -> int:
    """The largest bucket size: the sequence length a model is first laid out for."""
    return validated_buckets(buckets)[-1]


def batch_layout(order: DataFrame, batch_size: int, buckets: Sequence[int] = DEFAULT_BUCKETS,
                 bucket_col: str = "bucket") -> DataFrame:
    """Per batch of ``batch_order``: data shape (rows x bucket length), label shape
    (rows) and the default bucket key.  Every batch is full, so no row is read."""
    rows = F.lit(batch_size).cast("long")
    return order.select(
        "epoch",
        "batch_seq",
        bucket_col,
        F.array(rows, F.col(bucket_col).cast("long")).alias("data_shape"),
        F.array(rows).alias("label_shape"),
        F.lit(default_bucket_key(buckets)).cast("int").alias("default_bucket_key"),
    )


def batches_per_epoch(df: DataFrame, batch_size: int,
                      buckets: Sequence[int] = DEFAULT_BUCKETS) -> DataFrame:
    """``naive`` = floor(rows / batch_size) (can overcount); ``actual`` = full batches."""
    per_bucket = bucket_counts(df, buckets)
    bs = F.lit(batch_size)
    return per_bucket.agg(
        F.floor(F.coalesce(F.sum("n"), F.lit(0)) / bs).cast("long").alias("naive"),
        F.coalesce(F.sum(F.floor(F.col("n") / bs)), F.lit(0)).cast("long").alias("actual"),
    )


def fixed_batches(
    df: DataFrame,
    batch_size: int,
    shuffle: bool,
    seed: int = 42,
    epoch: int = 0,
    last_batch: str = "discard",
    row_col: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """Fixed-length batches over all rows: ``(epoch, batch, slot, row_id, pad, *keep)``.

    ``shuffle`` orders rows by the md5 key, otherwise by ``row_col``.
    ``last_batch='discard'`` drops the remainder; ``'pad'`` completes the last
    batch with rows from the start of the order, in as many rounds as it takes, and
    reports how many in ``pad``.
    """
    if last_batch not in ("discard", "pad"):
        raise ValueError(last_batch)
    base = df.select(row_col, *keep)
    if shuffle:
        keyed = base.withColumn("_key", shuffle_key(seed, epoch, row_col))
        ranked = rank_within(keyed, "_key", (), out="rank", tiebreak=[row_col], total_col="_total",
                             row_bytes=carried_bytes(base, keep) if keep else None).drop("_key")
    else:
        ranked = dense_index(base, [F.col(row_col).asc()], out="rank")
        total = ranked.count()
        ranked = ranked.withColumn("_total", F.lit(total).cast("long"))
    bs = F.lit(batch_size)
    n_full = F.floor(F.col("_total") / bs)
    if last_batch == "discard":
        out = ranked.withColumn("batch", F.floor(F.col("rank") / bs)).where(
            F.col("batch") < n_full).withColumn("slot", F.col("rank") % bs).withColumn("pad", F.lit(0))
    else:
        # The order repeats until the last batch is full: a row takes its own place and every
        # place a whole number of rounds later (fewer than batch_size places are filled).
        places = F.ceil(F.col("_total") / bs) * bs
        out = ranked.withColumn(
            "_place", F.explode(F.sequence(F.col("rank").cast("long"), places - 1, F.col("_total"))))
        batch = F.floor(F.col("_place") / bs)
        out = out.withColumn("batch", batch).withColumn("slot", F.col("_place") % bs).withColumn(
            "pad", F.when(batch == n_full, places - F.col("_total")).otherwise(0))
    return out.select(
        F.lit(epoch).cast("int").alias("epoch"),
        F.col("batch").cast("long").alias("batch"),
        F.col("slot").cast("int").alias("slot"),
        row_col,
        F.col("pad").cast("int").alias("pad"),
        *keep,
    )
