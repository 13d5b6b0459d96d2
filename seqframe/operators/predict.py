"""Class probabilities with label names, and the top class."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions.text import pad_tokens, tokens


def labelled_probs(probs: Column, label_names: Sequence[str]) -> Column:
    """array<double> -> array<struct<label, p>> (index i -> i-th label name)."""
    names = F.array(*[F.lit(n) for n in label_names]).cast("array<string>")
    return F.transform(
        probs,
        lambda p, i: F.struct(F.element_at(names, i + 1).alias("label"), p.alias("p")),
    )


def top_class(probs: Column, label_names: Sequence[str]) -> Column:
    """Highest probability; equal probabilities go to the lowest index."""
    names = F.array(*[F.lit(n) for n in label_names]).cast("array<string>")
    best = F.array_max(
        F.transform(
            probs,
            lambda p, i: F.struct(p.alias("p"), (-i).alias("neg_i"),
                                  F.element_at(names, i + 1).alias("label")),
        )
    )
    return F.struct(best["label"].alias("label"), best["p"].alias("p"), (-best["neg_i"]).alias("idx"))


def predict_proba(
    model: PipelineModel,
    df: DataFrame,
    label_names: Sequence[str],
    row_col: str = "row_id",
    keep: Sequence[str] = (),
) -> DataFrame:
    """``(row_id, *keep, probs, top)`` for every row of ``df`` (tokens column ``T``)."""
    scored = model.transform(df)
    probs = vector_to_array(F.col("probability"))
    return scored.select(
        row_col,
        *keep,
        labelled_probs(probs, label_names).alias("probs"),
        top_class(probs, label_names).alias("top"),
        F.col("prediction").cast("int").alias("prediction"),
    )


def predict_texts(
    model: PipelineModel,
    df: DataFrame,
    label_names: Sequence[str],
    text_col: str = "text",
    row_col: str = "row_id",
    max_tokens: int = 20,
) -> DataFrame:
    """Raw text -> tokens -> padded tokens -> probabilities, for a whole DataFrame.

    A null text has no tokens and gets the class priors.
    """
    padded = pad_tokens(tokens(text_col), max_tokens)
    prepared = df.withColumn("T", F.coalesce(padded, F.array().cast("array<string>")))
    return predict_proba(model, prepared, label_names, row_col)
