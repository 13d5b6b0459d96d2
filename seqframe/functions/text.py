"""Column -> Column text functions: characters, regex tokens, padding, buckets.

All of them are built-in Spark expressions, so they stay inside whole-stage
codegen, need no shuffle and also run on a streaming DataFrame.
"""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# The token normalisation rules, applied in this order to the
# whole string (Java regex syntax, Java replacement syntax).  The replacements
# for "(", ")" and "?" keep a backslash in front of the character, so the
# tokens are "\(", "\)" and "\?".  Lower-casing comes after these rules, which
# makes the contraction rules case-sensitive.
TOKEN_RULES: tuple[tuple[str, str], ...] = (
    (r"[^A-Za-z0-9(),!?'`]", " "),
    (r"'s", " 's"),
    (r"'ve", " 've"),
    (r"n't", " n't"),
    (r"'re", " 're"),
    (r"'d", " 'd"),
    (r"'ll", " 'll"),
    (r",", " , "),
    (r"!", " ! "),
    (r"\(", r" \\( "),
    (r"\)", r" \\) "),
    (r"\?", r" \\? "),
    (r"\s{2,}", " "),
)

# The pad token and the sequence length of the token path.
PAD_TOKEN = "<padded>"
MAX_TOKENS = 20

# Value for unseen terms/labels and for bucket padding.
UNSEEN = -1
# The length buckets of the character path.
DEFAULT_BUCKETS = (32, 64, 128, 256, 512, 1024)


def _col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def chars(text: Column | str) -> Column:
    """Lower-case, then split into single characters; '' -> [], null -> null."""
    t = _col(text)
    return F.when(F.length(t) == 0, F.array().cast("array<string>")).otherwise(
        F.split(F.lower(t), "")
    )


@functools.lru_cache(maxsize=None)
def _positive_class(pattern: str) -> str:
    """Rewrite a negated bracket class of literals and ranges as a positive class.

    ``[^A-Z_]`` becomes the ranges of every other code point.  The two match
    exactly the same characters; Java's regex engine runs the positive form
    about four times faster on mixed-script text.  Other patterns are returned
    unchanged.
    """
    if not (pattern.startswith("[^") and pattern.endswith("]")):
        return pattern
    body = pattern[2:-1]
    allowed: set[int] = set()
    i = 0
    while i < len(body):
        ch = body[i]
        if ch in "\\[]^&":
            return pattern  # escapes and nested classes are left to the engine
        if i + 2 < len(body) and body[i + 1] == "-":
            allowed.update(range(ord(ch), ord(body[i + 2]) + 1))
            i += 3
        else:
            allowed.add(ord(ch))
            i += 1
    ranges, start = [], None
    for cp in range(0, 0x110000):
        if cp in allowed:
            if start is not None:
                ranges.append((start, cp - 1))
                start = None
        elif start is None:
            start = cp
    if start is not None:
        ranges.append((start, 0x10FFFF))
    parts = [f"\\x{{{a:X}}}" if a == b else f"\\x{{{a:X}}}-\\x{{{b:X}}}" for a, b in ranges]
    return "[" + "".join(parts) + "]"


def normalize_for_tokens(text: Column | str) -> Column:
    """Apply the normalisation rules, then trim and lower-case."""
    t = _col(text)
    for pattern, replacement in TOKEN_RULES:
        t = F.regexp_replace(t, _positive_class(pattern), replacement)
    return F.lower(F.trim(t))


def tokens(text: Column | str) -> Column:
    """Regex tokens split on single spaces; '' -> ['']."""
    return F.split(normalize_for_tokens(text), " ")


def pad_sequence(seq: Column | str, length: int, pad: Column) -> Column:
    """Cut to ``length`` or pad on the right with ``pad`` up to ``length``."""
    s = _col(seq)
    return F.concat(
        F.slice(s, 1, length),
        F.array_repeat(pad, F.greatest(F.lit(length) - F.size(s), F.lit(0))),
    )


def pad_tokens(seq: Column | str, length: int = MAX_TOKENS, pad: str = PAD_TOKEN) -> Column:
    return pad_sequence(seq, length, F.lit(pad))


def validated_buckets(buckets: Sequence[int]) -> list[int]:
    """Sorted copy of the bucket sizes (the caller's list is left alone)."""
    out = sorted(int(b) for b in buckets)
    if not out or out[0] <= 0 or len(set(out)) != len(out):
        raise ValueError(f"bucket sizes must be distinct positive integers: {buckets!r}")
    return out


def bucket_of(length: Column | str, buckets: Sequence[int]) -> Column:
    """Smallest bucket >= length, else the largest bucket; null length -> null."""
    bs = validated_buckets(buckets)
    n = _col(length)
    expr = F.when(n.isNull(), F.lit(None)).when(n <= bs[0], F.lit(bs[0]))
    for b in bs[1:-1]:
        expr = expr.when(n <= b, F.lit(b))
    return expr.otherwise(F.lit(bs[-1])).cast("int")


def pad_to_bucket(seq: Column | str, bucket: Column | str, value: int = UNSEEN) -> Column:
    """Cut or pad (with ``value``) an index sequence to its bucket size."""
    s = _col(seq)
    b = _col(bucket)
    return F.concat(
        F.slice(s, 1, b),
        F.array_repeat(F.lit(value), F.greatest(b - F.size(s), F.lit(0))),
    )


def ints_to_string(seq: Column | str, sep: str = ",") -> Column:
    """Render an integer array as text (for reports and order-insensitive checks)."""
    # A cast of the whole array runs in generated code, a lambda per element does not.
    return F.array_join(_col(seq).cast("array<string>"), sep)
