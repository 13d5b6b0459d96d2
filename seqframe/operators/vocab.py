"""Vocabularies: term counts, frequency order with first-seen ties, dense index.

A vocabulary is a DataFrame ``(idx INT, term STRING, n BIGINT)``; the same table
serves term -> index and index -> term.  Order: count descending, ties by the
first occurrence in row order (row id, then position in the row), cut to an
optional cap.
"""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.operators.numbering import dense_index

# First-seen order is (row id, position).  A struct min() would force a sort
# aggregate, so the pair is packed into one number that keeps min() in a hash
# aggregate with map-side combine:
# * fast path, a bigint: row * 2**24 + pos, for 0 <= row < 2**39, pos < 2**24;
# * exact fallback, decimal(38,0): row * 10**18 + pos, for any other element.
# Only elements outside the fast range pay for decimal arithmetic.
_POS_BITS = 24
_ROW_LIMIT = 1 << (63 - _POS_BITS)
_POS_WEIGHT = 10**18
_DEC = "decimal(38,0)"
VOCAB_SCHEMA = "idx INT, term STRING, n BIGINT"


def first_seen_key(row_id: Column, pos: Column) -> Column:
    """Exact decimal key of (row id, position)."""
    return row_id.cast(_DEC) * F.lit(_POS_WEIGHT).cast(_DEC) + pos.cast(_DEC)


def _fits(row_id: Column, pos: Column) -> Column:
    return (row_id >= 0) & (row_id < F.lit(_ROW_LIMIT)) & (pos < F.lit(1 << _POS_BITS))


def _fast_key(row_id: Column, pos: Column) -> Column:
    return F.shiftleft(row_id, _POS_BITS) + pos.cast("long")


def _fast_to_exact(fast: Column) -> Column:
    row = F.shiftright(fast, _POS_BITS)
    pos = fast.bitwiseAND(F.lit((1 << _POS_BITS) - 1))
    return first_seen_key(row, pos)


def term_counts(df: DataFrame, seq_col: str, row_col: str = "row_id") -> DataFrame:
    """``(term, n, first)`` over all sequence elements; null sequences and elements add nothing."""
    # posexplode_outer + a filter on the generated position: a plain posexplode
    # makes the optimizer infer "size(seq) > 0" and push it below the
    # projections, which would evaluate the sequence expression again.
    exploded = df.select(
        F.col(row_col).cast("long").alias("_row"),
        F.posexplode_outer(F.col(seq_col)).alias("_pos", "term"),
    ).where(F.col("_pos").isNotNull() & F.col("term").isNotNull())
    row, pos = F.col("_row"), F.col("_pos")
    fits = _fits(row, pos)
    agg = exploded.groupBy("term").agg(
        F.count(F.lit(1)).alias("n"),
        F.min(F.when(fits, _fast_key(row, pos))).alias("_fast"),
        F.min(F.when(~fits, first_seen_key(row, pos))).alias("_slow"),
    )
    first = F.least(_fast_to_exact(F.col("_fast")), F.col("_slow"))
    return agg.select("term", "n", first.alias("first"))


def _order() -> list[Column]:
    return [F.col("n").desc(), F.col("first").asc()]


def rank_counts(counts: DataFrame, cap: int | None = None) -> DataFrame:
    """Dense index over ``(term, n, first)`` rows, optionally cut to ``cap``."""
    if cap is not None:
        if cap < 0:
            raise ValueError("cap must be >= 0")
        # TakeOrderedAndProject: each task keeps its best `cap` rows, so at
        # most cap x tasks rows meet in the final merge.
        top = counts.orderBy(*_order()).limit(int(cap))
        w = Window.orderBy(*_order())  # over <= cap rows
        ranked = top.withColumn("idx", F.row_number().over(w) - 1)
    else:
        ranked = dense_index(counts, _order(), out="idx")
    return ranked.select(
        F.col("idx").cast("int").alias("idx"),
        F.col("term").cast("string").alias("term"),
        F.col("n").cast("long").alias("n"),
    )


def build_vocab(
    df: DataFrame, seq_col: str, row_col: str = "row_id", cap: int | None = None
) -> DataFrame:
    """Vocabulary of the elements of an array column (characters or tokens)."""
    return rank_counts(term_counts(df, seq_col, row_col), cap)


def build_label_vocab(
    df: DataFrame, label_col: str = "label", row_col: str = "row_id", cap: int | None = None
) -> DataFrame:
    """Vocabulary of a scalar label column; null labels are not entries."""
    counts = (
        df.where(F.col(label_col).isNotNull())
        .groupBy(F.col(label_col).alias("term"))
        .agg(F.count(F.lit(1)).alias("n"), F.min(row_col).alias("first"))
    )
    return rank_counts(counts, cap)


def vocab_head(vocab: DataFrame, k: int = 10) -> DataFrame:
    """The first ``k`` entries (idx < k), in index order."""
    return vocab.where(F.col("idx") < k).orderBy("idx")


def vocab_terms(vocab: DataFrame, max_terms: int) -> list[str]:
    """Terms in index order, for a vocabulary checked to be at most ``max_terms``."""
    terms = small_terms(vocab, max_terms)
    if terms is None:
        raise ValueError(f"vocabulary has more than {max_terms} terms; use the join path")
    return terms


def small_terms(vocab: DataFrame, max_terms: int) -> list[str] | None:
    """Terms in index order, or None past ``max_terms``: one bounded collect decides."""
    rows = vocab.where(F.col("idx") <= max_terms).select("idx", "term").collect()
    if len(rows) > max_terms:
        return None
    return [r["term"] for r in sorted(rows, key=lambda r: r["idx"])]


def freeze_small_vocab(vocab: DataFrame, max_terms: int) -> DataFrame:
    """Compute a capped vocabulary once and keep it as a small local table.

    Later uses (lookups, writes, reports) then do not rerun the term count.
    """
    rows = vocab.where(F.col("idx") < max_terms + 1).select("idx", "term", "n").collect()
    if len(rows) > max_terms:
        raise ValueError(f"vocabulary has more than {max_terms} terms")
    rows = sorted((tuple(r) for r in rows), key=lambda r: r[0])
    return literal_vocab(vocab.sparkSession, rows)


def literal_vocab(spark, rows) -> DataFrame:
    """A small vocabulary ``[(idx, term, n), ...]`` as a JVM-side literal table.

    The rows travel as one JSON string literal parsed by ``from_json``: using
    the table never starts Python workers (``createDataFrame`` from Python rows
    would), and building it costs one expression, not one per value.
    """
    payload = json.dumps([{"idx": int(i), "term": t, "n": int(n)} for i, t, n in rows])
    items = F.from_json(F.lit(payload), "array<struct<idx:int,term:string,n:bigint>>")
    return spark.range(1).select(F.inline(items)).select("idx", "term", "n")


# Broadcast bounds of vocabulary lookups.  Both the number of terms and their
# bytes are checked: a token can be as long as a text without spaces.
BROADCAST_MAX_TERMS = 2_000_000
BROADCAST_MAX_BYTES = 128 * 1024 * 1024
# Past those bounds, the most frequent terms (the only possible hot keys) are
# still broadcast, each at most HOT_TERM_MAX_BYTES long: at most ~100 MB.
HOT_TERMS = 100_000
HOT_TERM_MAX_BYTES = 1024


def fits_broadcast(vocab: DataFrame, max_terms: int = BROADCAST_MAX_TERMS,
                   max_bytes: int = BROADCAST_MAX_BYTES) -> bool:
    """Whether the vocabulary's counted terms and term bytes are within the bounds."""
    r = vocab.agg(
        F.count(F.lit(1)).alias("n"),
        F.coalesce(F.sum(F.octet_length("term")), F.lit(0)).alias("bytes"),
    ).first()
    return int(r["n"]) <= max_terms and int(r["bytes"]) <= max_bytes


def hot_entry(idx: Column, term: Column, hot_terms: int = HOT_TERMS,
              max_term_bytes: int = HOT_TERM_MAX_BYTES) -> Column:
    """Entries broadcast on the split lookup path (never null, so it partitions)."""
    return (idx < F.lit(hot_terms)) & (
        F.coalesce(F.octet_length(term), F.lit(0)) <= F.lit(max_term_bytes)
    )


def term_of(vocab: DataFrame, idx_col: str, df: DataFrame, out: str = "term",
            broadcast_max_terms: int = BROADCAST_MAX_TERMS,
            broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
            hot_terms: int = HOT_TERMS) -> DataFrame:
    """Index -> term through the vocabulary table; unseen (< 0) -> null.

    The vocabulary is broadcast when its counted size and bytes allow.
    Otherwise the most frequent entries (the only possible hot keys) are still
    broadcast, only the tail is shuffle-joined, and negative indices skip the
    join.
    """
    inv = vocab.select(F.col("idx").alias(idx_col), F.col("term").alias(out))
    if fits_broadcast(vocab, broadcast_max_terms, broadcast_max_bytes):
        return df.join(F.broadcast(inv), on=idx_col, how="left")
    idx = F.col(idx_col)
    hot = hot_entry(idx, F.col(out), hot_terms)
    unseen = df.where(idx.isNull() | (idx < 0)).withColumn(out, F.lit(None).cast("string"))
    known = df.where(idx >= 0)
    first = known.join(F.broadcast(inv.where(hot)), on=idx_col, how="left")
    hits = first.where(F.col(out).isNotNull())
    rest = first.where(F.col(out).isNull()).drop(out).join(
        inv.where(~hot), on=idx_col, how="left")
    return hits.unionByName(rest).unionByName(unseen)
