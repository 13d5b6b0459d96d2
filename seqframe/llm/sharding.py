"""Sharding by a Feistel permutation of global row numbers, with cycle walking.

Rows get a global number 0..N-1; a keyed Feistel network over the rectangle
``a x b`` (``a = ceil(sqrt N)``, ``b = ceil(N / a)``) permutes the numbers, and
a value that falls outside 0..N-1 is permuted again until it falls inside
(cycle walking).  Shard and slot are then arithmetic: ``p mod shards`` and
``p div shards``, so shard sizes differ by one row at most, slots have no gaps,
and any row's place can be computed from its number and the seed alone.

Numbering needs no global sort: rows fall into hash slices, a table with one
count per slice gives offsets, and only the rows of a slice are sorted together.

Null ids, null or empty texts and repeated rows are ordinary rows (rows equal in
id, text size and checksum are interchangeable).  An empty table gives an empty
result.  Extra columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import read, slices_for

ROUNDS = 6
SEED = 20240601
SHARDS = 8


def feistel_sql(x: str, n: int, seed: int, tag: str = "") -> str:
    """SQL for one pass of the permutation of 0..a*b-1 over the bigint expression ``x``."""
    a, b = rectangle(n)
    rounds = ", ".join(
        f"named_struct('k', {seed * 31 + j}L, 'm', {a if j % 2 == 0 else b}L)" for j in range(ROUNDS)
    )
    s, t = f"s{tag}", f"t{tag}"
    return (
        f"aggregate(array({rounds}), named_struct('l', {x} % {a}L, 'r', {x} div {a}L), "
        f"({s}, {t}) -> named_struct('l', {s}.r, 'r', "
        f"({s}.l + pmod(xxhash64({s}.r, {t}.k), {t}.m)) % {t}.m), {s} -> {s}.r * {a}L + {s}.l)"
    )


def rectangle(n: int) -> tuple[int, int]:
    a = max(1, math.isqrt(max(0, n - 1)) + 1)
    return a, max(1, -(-n // a))


def permute(df: DataFrame, number: str, n: int, seed: int = SEED, out: str = "_p") -> DataFrame:
    """Add ``out``: a reproducible permutation of ``number`` (0..n-1, bigint)."""
    a, b = rectangle(n)
    outside = a * b - n
    df = df.withColumn(out, F.expr(feistel_sql(number, n, seed)))
    if outside:
        # A walk visits distinct values outside 0..n-1, so it ends within `outside` steps.
        again = feistel_sql("v", n, seed, "2")
        df = df.withColumn(out, F.expr(
            f"CASE WHEN {out} < {n}L THEN {out} ELSE aggregate(sequence(1, {outside}), {out}, "
            f"(v, i) -> CASE WHEN v < {n}L THEN v ELSE {again} END) END"
        ))
    return df


def row_numbers(df: DataFrame, n: int, order: Sequence[str], out: str = "_row") -> DataFrame:
    """Global numbers 0..n-1 in the order (hash slice of ``order``, ``order``)."""
    slices = slices_for(n)
    sliced = df.withColumn("_slice", F.pmod(F.xxhash64(*order), F.lit(slices)).cast("int"))
    running = Window.orderBy("_slice").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    # One row per slice: N / SLICE_ROWS rows (256 at least), small enough to broadcast.
    offsets = sliced.groupBy("_slice").agg(F.count(F.lit(1)).alias("_n")).select(
        "_slice", (F.sum("_n").over(running) - F.col("_n")).alias("_off"))
    w = Window.partitionBy("_slice").orderBy(*[F.col(c).asc_nulls_first() for c in order])
    return (
        sliced.withColumn("_rank", F.row_number().over(w) - 1)
        .join(F.broadcast(offsets), "_slice")
        .withColumn(out, (F.col("_off") + F.col("_rank")).cast("long"))
        .drop("_slice", "_rank", "_off")
    )


def shard(docs: DataFrame, shards: int = SHARDS, seed: int = SEED,
          carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, text_crc32, law, shard, slot, grown_shard`` and the ``carry`` columns.

    ``size`` is the text's UTF-8 bytes plus one (null: 1); ``text_crc32`` is null
    for a null text.
    """
    n = docs.count()
    cols = [F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)]
    rows = docs.select(
        "doc_id", (F.coalesce(F.octet_length("text"), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.col("text").cast("binary")).alias("text_crc32"), *cols)
    numbered = row_numbers(rows, n, ["doc_id", "text_crc32", "size"])
    p = permute(numbered, "_row", n, seed)
    placed = [
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"),
        (F.col("_p") % shards).cast("int").alias("shard"),
        F.expr(f"_p div {shards}").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    ]
    return p.select(*placed, *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)
                               if c != "doc_id"])


def op9_feistel_shards(spark, sf_dir):
    return shard(read(spark, sf_dir, "documents"))


QUERIES = {"op9_feistel_shards": op9_feistel_shards}
ORACLE_SQL: dict[str, str] = {}  # DuckDB has neither crc32 nor xxhash64; see tests/llm
