"""Row picks: first rows, an exact-size random sample, one random row.

Random order is an md5 of (seed, row id): reproducible, retry-safe and the same
in any engine.  The exact sample never sorts the whole table and never merges
more than a bounded number of rows in one task: it finds the md5 value of the
n-th row by refining a histogram of key prefixes, then keeps every row whose
key is at most that value, which is a plain distributed filter.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Hex digits added per refinement round (16**3 = 4,096 histogram cells).
_DIGITS_PER_ROUND = 3
# Rows in the last histogram cell that may be sorted in one task.
_FINAL_CELL_ROWS = 200_000


def sample_key(seed: int, row_col: str = "row_id") -> Column:
    return F.md5(F.concat_ws("|", F.lit(str(seed)), F.col(row_col).cast("string")))


def first_rows(df: DataFrame, n: int = 5, row_col: str = "row_id") -> DataFrame:
    """The first ``n`` rows in row order (a bounded top-n)."""
    return df.orderBy(row_col).limit(n)


def random_row(df: DataFrame, seed: int = 42, row_col: str = "row_id") -> DataFrame:
    """One row chosen by the seed."""
    return df.orderBy(sample_key(seed, row_col), F.col(row_col)).limit(1)


def sample_size(total: int, fraction: float) -> int:
    """Rows a fraction sample keeps: round(fraction * total), halves to even."""
    if not 0.0 <= fraction <= 1.0:
        raise ValueError("fraction must be in [0, 1]")
    return int(round(fraction * total))


def nth_key(keys: DataFrame, n: int, key_col: str = "_key") -> str | None:
    """The n-th smallest (1-based) value of a uniformly spread hex column."""
    if n <= 0:
        return None
    prefix, remaining = "", n
    while True:
        width = len(prefix) + _DIGITS_PER_ROUND
        cell = keys.where(F.col(key_col).startswith(prefix)) if prefix else keys
        hist = (
            cell.groupBy(F.substring(key_col, 1, width).alias("p"))
            .agg(F.count(F.lit(1)).alias("c"))
            .orderBy("p")
            .collect()  # at most 16**_DIGITS_PER_ROUND rows
        )
        seen = 0
        for row in hist:
            if seen + row["c"] >= remaining:
                prefix, remaining, size = row["p"], remaining - seen, row["c"]
                break
            seen += row["c"]
        else:
            return None
        if size <= _FINAL_CELL_ROWS or width >= 32:
            last = (
                keys.where(F.col(key_col).startswith(prefix))
                .orderBy(key_col)
                .limit(remaining)
                .agg(F.max(key_col))
                .first()[0]
            )
            return last


def exact_sample(
    df: DataFrame, fraction: float, seed: int = 42, row_col: str = "row_id"
) -> DataFrame:
    """Exactly round(fraction * rows) rows: those with the smallest keys."""
    keyed = df.withColumn("_key", sample_key(seed, row_col))
    n = sample_size(df.count(), fraction)
    if n == 0:
        return df.limit(0)
    threshold = nth_key(keyed.select("_key"), n)
    # Keys are md5 of distinct row ids, so they are distinct: exactly n rows pass.
    return keyed.where(F.col("_key") <= F.lit(threshold)).drop("_key")
