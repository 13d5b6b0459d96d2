"""Softmax text classifier on n-gram features, trained with pyspark.ml."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import LogisticRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.operators.features import DEFAULT_HASH_SLOTS, DEFAULT_NGRAMS, ngram_stages


def trainable(df: DataFrame, label_col: str = "Y") -> DataFrame:
    """Rows with a known label (unseen labels are -1 and cannot be learned)."""
    return df.where(F.col(label_col) >= 0)


def _classifier(reg_param: float, max_iter: int, features_col: str = "features") -> LogisticRegression:
    return LogisticRegression(
        featuresCol=features_col,
        labelCol="_label",
        family="multinomial",
        regParam=reg_param,
        maxIter=max_iter,
    )


def _labelled(train: DataFrame, label_col: str) -> DataFrame:
    return trainable(train, label_col).withColumn("_label", F.col(label_col).cast("double"))


def fit_features(train: DataFrame, features_col: str = "features", label_col: str = "Y",
                 reg_param: float = 0.01, max_iter: int = 20) -> PipelineModel:
    """``fit_classifier`` on rows that have their vectors; the model has the classifier alone."""
    lr = _classifier(reg_param, max_iter, features_col)
    return Pipeline(stages=[lr]).fit(_labelled(train, label_col))


def fit_classifier(
    train: DataFrame,
    tokens_col: str = "T",
    label_col: str = "Y",
    ns: Sequence[int] = DEFAULT_NGRAMS,
    num_features: int = DEFAULT_HASH_SLOTS,
    reg_param: float = 0.01,
    max_iter: int = 20,
) -> PipelineModel:
    stages = ngram_stages(tokens_col, ns, num_features, "features") + [_classifier(reg_param, max_iter)]
    return Pipeline(stages=stages).fit(_labelled(train, label_col))
