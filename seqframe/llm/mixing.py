"""Mixing sources to target weights by hash-random order and exact prefix-sum cuts.

Each source gets a target number of words (its weight's share of all words, at
most ``max_epochs`` times its own size, the excess reshared by weight).  Its
documents are ordered by a random key (md5 of seed and id); whole passes over
the source are taken while the target allows, and the last pass is cut at
the exact word where a prefix sum reaches the rest of the budget, so one document
per source at most is taken in part.

The order is never built by one task: the key's first hex digits cut every
source into slices that follow the key's order, a table of slice sums
gives each slice's starting sum, and only rows of a slice are sorted together.  A
source holding a third of all rows is cut into as many slices as the others.

Null and empty texts have size 0 and are taken 0 times; a null source is a source
of its own, last in order; repeated ids are ordered by size and text
hash.  An empty table gives an empty result; extra columns are ignored unless
named in ``carry``.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import (
    DOCUMENT_COLUMNS,
    SPACE_WORD,
    n_words,
    read,
    slices_for,
    source_key,
)
from seqframe.session import materialize

SEED = 17
MAX_EPOCHS = 3
#: A word with the white space before it; joined again they are the text's beginning.
LEADING_WORD = r"[\x20\x09-\x0D]*" + SPACE_WORD


def targets(sizes: DataFrame, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """``_sk, source_size, target`` from ``_sk, source, source_size`` (one row per source).

    Weights 1, 2, 3 repeat in the order of the sources.  Sources in order of
    ``size / weight`` are held at their ceiling while the level (words per unit
    weight left for the others) is above it; the rest get ``level * weight``.
    The windows run over one row per source.
    """
    by_name = Window.orderBy(F.col("source").isNull(), F.col("source"))
    whole = Window.partitionBy()
    w = sizes.withColumn("_rn", F.row_number().over(by_name)).withColumn(
        "_w", (F.col("_rn") - 1) % 3 + 1)
    w = w.withColumn("_ratio", F.lit(float(max_epochs)) * F.col("source_size") / F.col("_w"))
    before = Window.orderBy("_ratio", "_rn").rowsBetween(Window.unboundedPreceding, -1)
    w = w.select(
        "*",
        (F.sum("source_size").over(whole)
         - max_epochs * F.coalesce(F.sum("source_size").over(before), F.lit(0))).alias("_left"),
        (F.sum("_w").over(whole) - F.coalesce(F.sum("_w").over(before), F.lit(0))).alias("_wleft"),
    ).withColumn("_level", F.col("_left").cast("double") / F.col("_wleft"))
    level = F.max(F.when(F.col("_ratio") > F.col("_level"), F.col("_level"))).over(whole)
    return w.withColumn("_at", level).select(
        "_sk", "source_size",
        F.when(F.col("_ratio") <= F.col("_level"), F.col("source_size") * float(max_epochs))
        .otherwise(F.col("_at") * F.col("_w")).alias("target"))


def mix(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS,
        carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, size, source_size, target, taken`` and the ``carry`` columns."""
    digits = max(2, math.ceil(math.log(slices_for(docs.count()), 16)))
    rows = docs.select(
        "doc_id", source_key(F.col("source")).alias("_sk"), F.col("source").alias("_source"),
        n_words(F.col("text")).alias("size"), F.xxhash64("text").alias("_th"),
        F.md5(F.concat(F.lit(f"{seed}|"), F.coalesce(F.col("doc_id").cast("string"), F.lit("")))
              ).alias("_key"),
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
    ).withColumn("_slice", F.substring("_key", 1, digits))
    if not carry:
        rows = materialize(rows)  # narrow: counts words once for the sums and the cut
    per_slice = rows.groupBy("_sk", "_slice").agg(
        F.sum("size").alias("_s"), F.first("_source").alias("source"))
    per_slice = materialize(per_slice)  # sources x slices rows
    sizes = per_slice.groupBy("_sk").agg(
        F.sum("_s").alias("source_size"), F.first("source").alias("source"))
    running = Window.partitionBy("_sk").orderBy("_slice").rowsBetween(Window.unboundedPreceding, -1)
    plan = per_slice.select(
        "_sk", "_slice", F.coalesce(F.sum("_s").over(running), F.lit(0)).alias("_off")
    ).join(targets(sizes, max_epochs), "_sk").withColumn("_budget", F.floor("target")).withColumn(
        "_epochs", F.when(F.col("source_size") > 0,
                          F.expr("_budget div source_size")).otherwise(F.lit(0)))
    inside = Window.partitionBy("_sk", "_slice").orderBy("_key", "doc_id", "size", "_th").rowsBetween(
        Window.unboundedPreceding, -1)
    cut = rows.join(plan, ["_sk", "_slice"]).withColumn(
        "_before", F.col("_off") + F.coalesce(F.sum("size").over(inside), F.lit(0)))
    rest = F.col("_budget") - F.col("_epochs") * F.col("source_size") - F.col("_before")
    return cut.select(
        "doc_id", "size", "source_size", "target",
        (F.col("_epochs") * F.col("size")
         + F.greatest(F.lit(0), F.least(F.col("size"), rest))).cast("long").alias("taken"),
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry) if c != "doc_id"])


def apply_mix(docs: DataFrame, seed: int = SEED, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The mixed documents: one row per whole pass, one with the first words for a partial one.

    Documents without words, or beyond their source's cut, have no row.
    """
    taken = mix(docs, seed, max_epochs, carry=DOCUMENT_COLUMNS).where("taken > 0")
    passes = taken.withColumn("_i", F.explode(F.expr("sequence(1L, ceil(taken / size))")))
    part = F.col("taken") - (F.col("_i") - 1) * F.col("size")
    words = F.regexp_extract_all("text", F.lit(LEADING_WORD), F.lit(0))
    text = F.when(part >= F.col("size"), F.col("text")).otherwise(
        F.array_join(F.slice(words, F.lit(1), part.cast("int")), ""))
    return passes.withColumn("_whole", part >= F.col("size")).withColumn("text", text).select(
        "doc_id", "text", "lang", "source",
        F.when(F.col("_whole"), F.col("n_chars")).otherwise(F.length("text")).cast("long").alias(
            "n_chars"))


def op6_mix(spark, sf_dir):
    return mix(read(spark, sf_dir, "documents"))


QUERIES = {"op6_mix": op6_mix}

ORACLE_SQL = {"op6_mix": rf"""
WITH d AS (
  SELECT doc_id, source, md5('{SEED}|' || doc_id::VARCHAR) AS k,
    len(regexp_extract_all(coalesce(text, ''), '{SPACE_WORD}'))::BIGINT AS size
  FROM documents
), s AS (
  SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source
), w AS (
  SELECT *, row_number() OVER (ORDER BY source NULLS LAST) AS rn FROM s
), w2 AS (
  SELECT *, (rn - 1) % 3 + 1 AS wt, 3.0::DOUBLE * source_size / ((rn - 1) % 3 + 1) AS ratio FROM w
), w3 AS (
  SELECT *, (SELECT sum(source_size) FROM s) - 3 * coalesce(sum(source_size) OVER b, 0) AS room,
    (SELECT sum(wt) FROM w2) - coalesce(sum(wt) OVER b, 0) AS wleft
  FROM w2 WINDOW b AS (ORDER BY ratio, rn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)
), w4 AS (
  SELECT *, room::DOUBLE / wleft::DOUBLE AS lvl FROM w3
), t AS (
  SELECT source, source_size, CASE WHEN ratio <= lvl THEN source_size * 3.0::DOUBLE
    ELSE (SELECT max(lvl) FROM w4 WHERE ratio > lvl) * wt END AS target
  FROM w4
), c AS (
  SELECT d.*, t.source_size, t.target, floor(t.target)::BIGINT AS budget,
    coalesce(sum(size) OVER (PARTITION BY d.source ORDER BY k, doc_id
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source
)
SELECT doc_id, size, source_size, target,
  CASE WHEN source_size = 0 THEN 0 ELSE (budget // source_size) * size
    + greatest(0, least(size, budget % source_size - before)) END::BIGINT AS taken
FROM c"""}
