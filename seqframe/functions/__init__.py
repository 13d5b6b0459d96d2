"""Column -> Column functions (built-in Spark expressions only)."""

from seqframe.functions.labels import NEWS_LABELS, label_name, with_label_names
from seqframe.functions.text import (
    DEFAULT_BUCKETS,
    MAX_TOKENS,
    PAD_TOKEN,
    TOKEN_RULES,
    UNSEEN,
    bucket_of,
    chars,
    ints_to_string,
    normalize_for_tokens,
    pad_sequence,
    pad_to_bucket,
    pad_tokens,
    tokens,
    validated_buckets,
)

__all__ = [
    "DEFAULT_BUCKETS",
    "MAX_TOKENS",
    "NEWS_LABELS",
    "PAD_TOKEN",
    "TOKEN_RULES",
    "UNSEEN",
    "bucket_of",
    "chars",
    "ints_to_string",
    "label_name",
    "normalize_for_tokens",
    "pad_sequence",
    "pad_to_bucket",
    "pad_tokens",
    "tokens",
    "validated_buckets",
    "with_label_names",
]
