"""Accuracy of predictions against the indexed label."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def accuracy(pred: DataFrame, label_col: str = "Y", pred_col: str = "prediction",
             majority: bool = False) -> DataFrame:
    """``(n, n_correct, accuracy, n_unlabelled)``; rows with label -1 are only counted.

    Without a labelled row the accuracy is null.  ``majority`` adds the share of
    the commonest class, the accuracy of always answering it.
    """
    # One row per class, combined map-side.
    known = F.col("_y") >= 0
    classes = pred.groupBy(F.col(label_col).alias("_y")).agg(
        F.count(F.lit(1)).alias("_n"),
        F.sum((F.col(pred_col) == F.col(label_col)).cast("long")).alias("_c"))
    of_known = lambda c: F.when(known, F.col(c)).otherwise(0)
    extra = [F.try_divide(F.max(of_known("_n")), F.sum(of_known("_n"))).alias("majority")]
    return classes.agg(
        F.sum(of_known("_n")).alias("n"),
        F.sum(of_known("_c")).alias("n_correct"),
        F.try_divide(F.sum(of_known("_c")), F.sum(of_known("_n"))).alias("accuracy"),
        F.sum(F.when(known, 0).otherwise(F.col("_n"))).alias("n_unlabelled"),
        *(extra if majority else []),
    )
