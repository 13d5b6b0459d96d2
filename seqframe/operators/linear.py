"""Softmax scoring and training as relational plans: weights are a table, not a driver-side matrix.

``weights`` has ``term, cls, w`` and ``bias`` has ``cls, w``; a row's features are rows ``row_id, term``
(presence).  A row's scores are the sum of its terms' weights by join and aggregation, its probabilities
a stable softmax over its (few) classes.  A gradient is the opposite join: residuals by row, summed by
(term, class) with map-side combine, so a term that every row has is one partial sum a task.

``train_steps`` writes each step's weights and then its accuracies to a folder of its own; a new call on
the same folder goes on after the last step whose accuracies were written.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.errors import AnalysisException
from pyspark.ml.classification import LogisticRegressionModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.operators.ngrams import BROADCAST_ROWS, HEAVY_ROWS, lookup
from seqframe.session import materialize, store_table

#: Probabilities that agree in so many digits count as equal for the top class.
DIGITS = 9


def by_term(weights: DataFrame, classes: Sequence[int]) -> DataFrame:
    """One row per term with its weight for every class of ``classes`` (``_w0, _w1, ...``; null: no entry)."""
    return weights.groupBy("term").agg(*[
        F.sum(F.when(F.col("cls") == c, F.col("w"))).alias(f"_w{k}") for k, c in enumerate(classes)])


def by_class(classes: Sequence[int], prefix: str, name: str) -> Column:
    """Array of ``cls, <name>`` of the classes whose column ``<prefix>0, ...`` is not null."""
    entries = F.array(*[F.struct(F.lit(c).cast("int").alias("cls"), F.col(f"{prefix}{k}").alias(name))
                        for k, c in enumerate(classes)])
    return F.filter(entries, lambda e: e[name].isNotNull())


def scores(rows: DataFrame, features: DataFrame, weights: DataFrame, bias: DataFrame,
           row_col: str = "row_id", max_rows: int = BROADCAST_ROWS, heavy_rows: int = HEAVY_ROWS) -> DataFrame:
    """``row_id, s``: an array of ``cls, s`` by class for every row of ``rows``, featureless ones too.

    A model has few classes, so a term's weights and a row's scores are columns: one row per feature is
    joined, and one per row and task is shuffled.
    """
    start: dict[int, float] = {}
    for r in bias.select("cls", "w").collect():
        start[r["cls"]] = start.get(r["cls"], 0.0) + r["w"]
    classes = sorted({*start, *(r["cls"] for r in weights.select("cls").distinct().collect())})
    names = [f"_w{k}" for k in range(len(classes))]
    # Asked for its size and then joined.
    table = materialize(by_term(weights, classes))
    # The commonest terms of the rows are the hot keys of the join.
    if table.count() > max_rows:
        # Both are read several times below; the features often come from a join.
        features = store_table(features.select(row_col, "term"), "features")
        table = store_table(table.join(features.groupBy("term").agg(F.count(F.lit(1)).alias("_df")), "term"),
                            "weighted")
    else:
        table = table.withColumn("_df", F.lit(1))
    each = lookup(features.select(row_col, "term"), table, ["term"], "_df", max_rows, heavy_rows).select(
        row_col, *names)
    # The bias is a literal, so no row-less join is needed.
    first = rows.select(row_col, *[F.lit(start.get(c)).cast("double").alias(f"_w{k}") for k, c in enumerate(classes)])
    sums = each.unionByName(first).groupBy(row_col).agg(*[F.sum(c).alias(c) for c in names])
    return sums.select(row_col, by_class(classes, "_w", "s").alias("s"))


def softmax(s: Column) -> Column:
    """Array of ``cls, p`` from an array of ``cls, s``; the largest score is subtracted first."""
    top = F.array_max(F.transform(s, lambda x: x["s"]))
    exps = F.transform(s, lambda x: F.exp(x["s"] - top))
    total = F.aggregate(exps, F.lit(0.0), lambda a, x: a + x)
    return F.transform(s, lambda x: F.struct(x["cls"].alias("cls"), (F.exp(x["s"] - top) / total).alias("p")))


def top_of(probs: Column) -> Column:
    """Most probable class; the lowest of equal ones."""
    return -F.array_max(F.transform(
        probs, lambda x: F.struct(F.round(x["p"], DIGITS).alias("p"), (-x["cls"]).alias("c"))))["c"]


def predict(rows: DataFrame, features: DataFrame, weights: DataFrame, bias: DataFrame,
            row_col: str = "row_id", **bounds: int) -> DataFrame:
    """``row_id, probs, prediction`` for every row of ``rows``."""
    found = scores(rows, features, weights, bias, row_col, **bounds).select(
        row_col, softmax(F.col("s")).alias("probs"))
    return found.withColumn("prediction", top_of(F.col("probs")).cast("int"))


def exported(spark: SparkSession, model: LogisticRegressionModel) -> tuple[DataFrame, DataFrame]:
    """``weights`` and ``bias`` tables of a fitted multinomial model; ``term`` is the feature's index."""
    matrix = model.coefficientMatrix.toArray()
    cls, term = np.nonzero(matrix)
    weights = spark.createDataFrame(
        list(zip(term.tolist(), cls.tolist(), matrix[cls, term].tolist(), strict=True)),
        "term long, cls int, w double")
    bias = spark.createDataFrame(list(enumerate(model.interceptVector.toArray().tolist())), "cls int, w double")
    return weights, bias


def packed(features: DataFrame, row_col: str = "row_id") -> DataFrame:
    """One row per ``row_col`` with its ``terms``: a join by row moves rows, not features."""
    return features.groupBy(row_col).agg(F.collect_list("term").alias("terms"))


def gradient_step(rows: DataFrame, terms: DataFrame, probs: DataFrame, weights: DataFrame, bias: DataFrame, n: int,
                  rate: float, l2: float, row_col: str = "row_id") -> tuple[DataFrame, DataFrame]:
    """Weights and bias after one step of full-batch gradient descent.

    ``rows`` has ``row_id, Y``, ``terms`` comes from ``packed``, ``probs`` from ``predict`` with ``weights``
    and ``bias``.
    """
    classes = sorted({r["cls"] for r in bias.select("cls").collect()})
    names = [f"_r{k}" for k in range(len(classes))]

    def residual(c: int) -> Column:
        p = F.get(F.filter("probs", lambda x: x["cls"] == c), F.lit(0))["p"]
        return p - (F.col("Y") == c).cast("double")

    left = materialize(rows.select(row_col, "Y").join(probs, row_col).select(
        row_col, *[residual(c).alias(name) for c, name in zip(classes, names, strict=True)]))
    slope = terms.join(left, row_col).select(F.explode("terms").alias("term"), *names).groupBy("term").agg(
        *[(F.sum(r) / n).alias(r) for r in names])
    both = slope.join(by_term(weights, classes), "term", "full")
    moved = [F.struct(F.lit(c).cast("int").alias("cls"), F.when(
        F.col(f"_w{k}").isNotNull() | F.col(f"_r{k}").isNotNull(),
        F.coalesce(f"_w{k}", F.lit(0.0)) * (1 - rate * l2) - rate * F.coalesce(f"_r{k}", F.lit(0.0))).alias("w"))
        for k, c in enumerate(classes)]
    moved = both.select("term", F.explode(F.filter(F.array(*moved), lambda e: e["w"].isNotNull())).alias("_e")).select(
        "term", "_e.cls", "_e.w")
    lean = left.agg(*[(F.sum(r) / n).alias(r) for r in names]).select(
        F.explode(F.array(*[F.struct(F.lit(c).cast("int").alias("cls"), F.col(r).alias("g"))
                            for c, r in zip(classes, names, strict=True)])).alias("_e")).select("_e.cls", "_e.g")
    return moved, bias.join(lean, "cls", "left").select(
        "cls", (F.col("w") - rate * F.coalesce("g", F.lit(0.0))).alias("w"))


def _written(spark: SparkSession, path: str) -> DataFrame | None:
    try:
        return spark.read.parquet(path)
    except AnalysisException:
        return None


def train_steps(rows: DataFrame, features: DataFrame, n_classes: int, steps: int, folder: str,
                rate: float = 1.0, l2: float = 0.0, row_col: str = "row_id") -> DataFrame:
    """``step, split, n, n_correct`` after 0 to ``steps`` steps; ``rows`` has ``row_id, split, Y``.

    Only rows of split ``train`` with a known class (``Y`` of 0 or more) are learned, all known ones are
    evaluated.
    """
    spark = rows.sparkSession
    known = rows.where("Y >= 0")
    train = known.where("split = 'train'").select(row_col, "Y")
    n = train.count()
    # Terms of the rows to learn, by row: every step joins them with the residuals.
    terms = store_table(packed(features, row_col).join(train.select(row_col), row_col, "left_semi"), "terms")
    found = None  # what the weights of the step before answer
    for step in range(steps + 1):
        at = f"{folder.rstrip('/')}/step={step}"
        if _written(spark, f"{at}/accuracy") is not None:
            found = None
            continue
        if step == 0:
            weights = spark.createDataFrame([], "term long, cls int, w double")
            bias = spark.range(n_classes).select(F.col("id").cast("int").alias("cls"), F.lit(0.0).alias("w"))
        else:
            before = f"{folder.rstrip('/')}/step={step - 1}"
            old, lean = spark.read.parquet(f"{before}/weights"), spark.read.parquet(f"{before}/bias")
            if found is None:
                found = predict(known, features, old, lean, row_col)
            weights, bias = gradient_step(train, terms, found.select(row_col, "probs"), old, lean, max(n, 1), rate, l2,
                                          row_col)
        weights.write.mode("overwrite").parquet(f"{at}/weights")
        bias.write.mode("overwrite").parquet(f"{at}/bias")
        # One evaluation serves the accuracy and the next step's gradient.
        found = store_table(predict(known, features, spark.read.parquet(f"{at}/weights"),
                                    spark.read.parquet(f"{at}/bias"), row_col), "found")
        known.join(found.drop("probs"), row_col).groupBy("split").agg(
            F.count(F.lit(1)).alias("n"),
            F.sum((F.col("prediction") == F.col("Y")).cast("long")).alias("n_correct")).select(
            F.lit(step).alias("step"), "split", "n", "n_correct").coalesce(1).write.mode("overwrite").parquet(
            f"{at}/accuracy")
    return spark.read.parquet(*[f"{folder.rstrip('/')}/step={k}/accuracy" for k in range(steps + 1)])
