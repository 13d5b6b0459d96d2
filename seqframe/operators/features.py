"""Binary n-gram presence features (the Spark counterpart of max-pooled n-gram filters)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline
from pyspark.ml.feature import HashingTF, NGram, VectorAssembler

DEFAULT_NGRAMS = (1, 3, 4, 5)
DEFAULT_HASH_SLOTS = 4096


def ngram_stages(
    tokens_col: str = "T",
    ns: Sequence[int] = DEFAULT_NGRAMS,
    num_features: int = DEFAULT_HASH_SLOTS,
    out: str = "features",
) -> list:
    """NGram + HashingTF(binary) per n, assembled into one sparse vector."""
    stages, parts = [], []
    for n in ns:
        src = tokens_col
        if n > 1:
            src = f"_ngram{n}"
            stages.append(NGram(n=n, inputCol=tokens_col, outputCol=src))
        tf = f"_hashed{n}"
        stages.append(HashingTF(inputCol=src, outputCol=tf, numFeatures=num_features, binary=True))
        parts.append(tf)
    stages.append(VectorAssembler(inputCols=parts, outputCol=out))
    return stages


def ngram_featurizer(
    tokens_col: str = "T",
    ns: Sequence[int] = DEFAULT_NGRAMS,
    num_features: int = DEFAULT_HASH_SLOTS,
    out: str = "features",
) -> Pipeline:
    """Stateless (nothing to fit): ``.fit(df)`` returns immediately."""
    return Pipeline(stages=ngram_stages(tokens_col, ns, num_features, out))
