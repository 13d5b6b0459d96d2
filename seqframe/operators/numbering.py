"""Distributed numbering: dense 0-based positions in a total order.

A plain ``row_number()`` over ``Window.orderBy(...)`` (or over a skewed
``partitionBy``) moves every row through one task.  The two helpers here keep
the work spread out and only bring a small, bounded table of offsets together:

* ``rank_within`` numbers rows by a uniformly distributed hex key (an md5)
  inside a few coarse groups (buckets, epochs).  The first ``salt_chars`` hex
  digits of the key split each group into sub-groups whose order agrees with
  the key, so ``row_number`` runs per sub-group and a running sum of the
  sub-group sizes gives each sub-group's offset.  The salt width follows the
  size of the largest group, so a group holding a third of all rows is still
  cut into task-sized pieces.  Where rows carry data of any length, the width
  follows the largest group's bytes as well.
* ``dense_index`` numbers rows in any total order (for example "count
  descending, first seen ascending").  It range-partitions on the order,
  numbers rows inside each range partition with ``monotonically_increasing_id``
  after a sort, and freezes that assignment with a reliable checkpoint (the
  cluster's ``spark.checkpoint.dir``) before adding per-partition offsets.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.session import ensure_checkpoint_dir

# Rows per (group, salt) sub-group that one task sorts for its row_number.
TARGET_GROUP_ROWS = 2_000_000
TARGET_GROUP_BYTES = 256 << 20
MAX_SALT_CHARS = 6
# Digits that one running sum goes over: at most 16**3 rows a group in a task.
WINDOW_CHARS = 3


def salt_chars_for(max_group_rows: int, target_rows: int = TARGET_GROUP_ROWS,
                   max_group_bytes: int = 0, target_bytes: int = TARGET_GROUP_BYTES) -> int:
    """Hex digits of salt so that max_group_rows / 16**d <= target_rows, and likewise the bytes."""
    share = max(max_group_rows / target_rows, max_group_bytes / target_bytes)
    if share <= 1:
        return 1
    return min(MAX_SALT_CHARS, max(1, math.ceil(math.log(share, 16))))


def group_bounds(df: DataFrame, parts: Sequence[str], row_bytes: Column | None = None) -> tuple[int, int]:
    """Rows of the largest group and bytes (sum of ``row_bytes``) of the heaviest, in one aggregate."""
    size = F.lit(0) if row_bytes is None else F.coalesce(row_bytes, F.lit(0))
    sums = df.groupBy(*parts).agg(F.count(F.lit(1)).alias("_n"), F.sum(size.cast("long")).alias("_b"))
    r = sums.agg(F.max("_n"), F.max("_b")).first()
    return int(r[0] or 0), int(r[1] or 0)


def _offsets(sizes: DataFrame, parts: Sequence[str], salt_chars: int, total_col: str | None) -> DataFrame:
    """``(*parts, _salt, _off)``: rows of the group before each sub-group of ``sizes``.

    Past ``WINDOW_CHARS`` digits the running sum is taken in two levels, within the sub-groups of a
    common head and over the heads, so that no task orders more than 16**WINDOW_CHARS rows of a group.
    """
    def before(order: str, *groups: str) -> Column:
        w = Window.partitionBy(*groups).orderBy(order).rowsBetween(
            Window.unboundedPreceding, Window.currentRow)
        return F.sum("_n").over(w) - F.col("_n")

    whole = [F.sum("_n").over(Window.partitionBy(*parts)).alias(total_col)] if total_col else []
    if salt_chars <= WINDOW_CHARS:
        return sizes.select(*parts, "_salt", before("_salt", *parts).alias("_off"), *whole)
    headed = sizes.withColumn("_head", F.substring("_salt", 1, salt_chars - WINDOW_CHARS))
    heads = headed.groupBy(*parts, "_head").agg(F.sum("_n").alias("_n")).select(
        *parts, "_head", before("_head", *parts).alias("_base"), *whole)
    inside = headed.withColumn("_off", before("_salt", *parts, "_head"))
    return inside.join(heads, [*parts, "_head"]).select(
        *parts, "_salt", (F.col("_base") + F.col("_off")).alias("_off"), *([total_col] if total_col else []))


def rank_within(
    df: DataFrame,
    key_col: str,
    partition_cols: Sequence[str] = (),
    out: str = "rank",
    tiebreak: Sequence[str] = (),
    salt_chars: int | None = None,
    target_group_rows: int = TARGET_GROUP_ROWS,
    total_col: str | None = None,
    row_bytes: Column | None = None,
    target_group_bytes: int = TARGET_GROUP_BYTES,
) -> DataFrame:
    """0-based rank by ``key_col`` (a lower-case hex string) within ``partition_cols``.

    ``partition_cols`` must have few distinct values (buckets, epochs); they
    may be arbitrarily skewed.  Equal to
    ``row_number() over (partition by partition_cols order by key, tiebreak) - 1``.
    With ``total_col``, also adds the number of rows of the row's group.
    ``row_bytes`` is the size of what a row carries through the sort; a group of few
    long rows is then cut as finely as its bytes ask for.

    ``partition_cols`` should be stored values (a written or checkpointed
    table): the join with the offsets implies ``IS NOT NULL`` on them, and
    Catalyst pushes that filter below any projection that derives them,
    evaluating the deriving expression again inside the filter.
    """
    parts = list(partition_cols)
    if salt_chars is None:
        rows, size = group_bounds(df, parts, row_bytes)
        salt_chars = salt_chars_for(rows, target_group_rows, size, target_group_bytes)
    salt = "_salt"
    salted = df.withColumn(salt, F.substring(F.col(key_col), 1, salt_chars))
    groups = parts + [salt]
    sizes = salted.groupBy(*groups).agg(F.count(F.lit(1)).alias("_n"))
    offsets = _offsets(sizes, parts, salt_chars, total_col)
    # Same keys as the window below, so the big side is shuffled once.
    joined = salted.join(offsets, on=groups, how="inner")
    order = [F.col(key_col)] + [F.col(c) for c in tiebreak]
    w = Window.partitionBy(*groups).orderBy(*order)
    return joined.withColumn(out, F.row_number().over(w) - 1 + F.col("_off")).drop(salt, "_off")


def dense_index(
    df: DataFrame,
    order: Sequence[Column],
    out: str = "idx",
    num_partitions: int | None = None,
) -> DataFrame:
    """0-based position of each row in the total order ``order``.

    ``order`` must be a total order (ties broken by a unique column), so that
    the result does not depend on how rows arrive.
    """
    spark = df.sparkSession
    ensure_checkpoint_dir(spark)
    n_parts = num_partitions or int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = (
        df.repartitionByRange(n_parts, *order)
        .sortWithinPartitions(*order)
        .withColumn("_pid", F.spark_partition_id())
        .withColumn(
            "_local",
            F.monotonically_increasing_id() - F.shiftleft(F.col("_pid").cast("long"), 33),
        )
    )
    # Freeze partition ids and in-partition positions: both depend on the
    # physical plan, so they must not be recomputed differently later.
    frozen = ranged.checkpoint(eager=True)
    sizes = frozen.groupBy("_pid").agg(F.count(F.lit(1)).alias("_n"))
    running = Window.orderBy("_pid").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # At most num_partitions rows: a proven bound, so broadcasting is safe.
    offsets = sizes.select("_pid", (F.sum("_n").over(running) - F.col("_n")).alias("_off"))
    return (
        frozen.join(F.broadcast(offsets), on="_pid", how="inner")
        .withColumn(out, F.col("_off") + F.col("_local"))
        .drop("_pid", "_local", "_off")
    )
