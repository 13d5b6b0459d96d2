"""Plain-Python statements of the semantics, written from the descriptions.

Used only by the tests as an independent oracle for the Spark operators.
"""

from __future__ import annotations

import re
from collections import Counter

RULES = [
    (r"[^A-Za-z0-9(),!?'`]", " "),
    (r"'s", " 's"),
    (r"'ve", " 've"),
    (r"n't", " n't"),
    (r"'re", " 're"),
    (r"'d", " 'd"),
    (r"'ll", " 'll"),
    (r",", " , "),
    (r"!", " ! "),
    (r"\(", " \\\\( "),
    (r"\)", " \\\\) "),
    (r"\?", " \\\\? "),
    (r"\s{2,}", " "),
]


def py_tokens(s: str) -> list[str]:
    for p, r in RULES:
        s = re.sub(p, r, s)
    return s.strip().lower().split(" ")


def py_pad(t: list[str], n: int = 20, pad: str = "<padded>") -> list[str]:
    return t[:n] if len(t) > n else t + [pad] * (n - len(t))


def py_chars(s: str) -> list[str]:
    return list(s.lower())


def py_vocab(seqs: list[list[str]], cap: int | None) -> list[tuple[int, str, int]]:
    c = Counter(x for s in seqs for x in s)
    return [(i, t, n) for i, (t, n) in enumerate(c.most_common(cap))]


def py_bucket(n: int, buckets: list[int]) -> int:
    for b in sorted(buckets):
        if n <= b:
            return b
    return max(buckets)
