"""Spelling variants against all pairs of words, with edge rows."""

import random
import re
import zlib
from collections import Counter

import numpy as np
from hypothesis import given, settings
from hypothesis import strategies as st

from seqframe.llm import variants

COLUMNS = ["word", "form", "root", "n", "n_near", "form_n"]


def plain_words(rows):
    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in run)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if h % 97 == 0:
                k = h % len(run)
                run = run[:k] + run[k + 1:]
            counts[run] += 1
    return {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}


def plain_near(a, b):
    """Edit distance of one, by all edits."""
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    if len(a) > len(b):
        a, b = b, a
    return len(b) == len(a) + 1 and any(b[:k] + b[k + 1:] == a for k in range(len(b)))


def plain_variants(words):
    found, forms = {}, {}
    for w, n in words.items():
        near = [x for x in words if plain_near(w, x)]
        best = min(near, key=lambda x: (-words[x], x), default=None)
        forms[w] = best if best is not None and words[best] >= 2 * n else None
        found[w] = len(near)
    out = set()
    for w, n in words.items():
        root = w
        while forms[root] is not None:
            root = forms[root]
        f = forms[w]
        out.add((w, f, root, n, found[w], words[f] if f else None))
    return out


def corpus(rng, n_docs, base):
    """Documents of misspelt base words; a few base words make up most of the text."""
    rows = []
    for i in range(n_docs):
        words = []
        for _ in range(rng.randint(0, 120)):
            w = rng.choice(base[:4] if rng.random() < 0.4 else base)
            if rng.random() < 0.3:
                k = rng.randrange(len(w))
                w = rng.choice([w[:k] + w[k + 1:], w[:k] + rng.choice("aeinç") + w[k:],
                                w[:k] + rng.choice("aeinç") + w[k + 1:]])
            words.append(rng.choice([w, w.upper(), w.capitalize()]))
        rows.append((i, rng.choice([" ", ", ", "\n", "1"]).join(words)))
    return rows


def result(df):
    assert df.columns == COLUMNS
    rows = [tuple(r) for r in df.collect()]
    assert len(rows) == len(set(rows))
    return set(rows)


def test_against_all_pairs(spark, docs):
    rng = random.Random(11)
    base = ["".join(rng.choice("abcdeinorstßé") for _ in range(rng.randint(4, 12))) for _ in range(60)]
    base += [x[::-1] for x in base[:10]] + ["".join(sorted(x)) for x in base[:10]]  # equal vectors
    rows = corpus(rng, 150, base)
    words = plain_words(rows)
    want = plain_variants(words)
    assert len(words) > 250 and sum(f is not None for _, f, *_ in want) > 50
    counted = variants.vocabulary(docs(rows, extra=True))
    assert {(r["word"], r["n"]) for r in counted.collect()} == set(words.items())
    for stretch in (10_000, 7):  # one stretch, and some fifty that share vectors
        assert result(variants.group_variants(counted, stretch)) == want


def test_edge_rows(docs):
    rows = [(None, "wordy " * 5), (1, None), (2, ""), (3, "1 2 3 é"), (4, "wordy wordx"), (4, "wordy wordx"),
            (5, "Wordx WORDX, wordxx "), (6, "wordxx " * 2), (7, "a" * 300_000), (8, "a" * 300_000),
            (9, "a" * 300_000 + " " + "a" * 300_001), (10, "a" * 300_001 + "1" + "a" * 300_001),
            (11, "tieto tietn " * 3 + "tieta " * 6 + "tieti " * 6), (12, "abcd× abcd÷ÿ " * 4)]
    got = result(variants.group_variants(variants.vocabulary(docs(rows, extra=True)), 3))
    assert got == plain_variants(plain_words(rows))
    assert variants.group_variants(variants.vocabulary(docs([]))).count() == 0
    assert variants.group_variants(variants.vocabulary(docs([(1, "too short")]))).count() == 0


def test_chains_lead_to_the_last_form(spark):
    words = {"abcde" + "x" * k: 3 * 2**k for k in range(20)}
    df = spark.createDataFrame(list(words.items()), "word string, n long")
    got = result(variants.group_variants(df, 4))
    assert got == plain_variants(words) and {r[2] for r in got} == {"abcde" + "x" * 19}


LETTERS = st.text("abceénÿ", min_size=5, max_size=9)


@settings(max_examples=400, deadline=None)
@given(LETTERS, LETTERS, st.integers(0, 8), st.sampled_from(["", "a", "é"]), st.integers(0, 1))
def test_near_and_budget(a, other, at, put, cut):
    b = a[:at] + put + a[at + cut:]
    for x, y in ((a, b), (b, a), (a, other)):
        assert variants.near(x, y) == plain_near(x, y)
        if plain_near(x, y):  # an edit stays within the budget of one surplus and one deficit
            found = list(variants.search(variants.vectors([y]), variants.vectors([x])))
            assert [(who.tolist(), row) for who, row in found] == [([0], 0)]


@settings(max_examples=150, deadline=None)
@given(st.lists(LETTERS, min_size=1, max_size=40, unique=True), st.integers(1, 6))
def test_search_and_directory_find_all_vectors_in_budget(words, size):
    v = variants.vectors(words)
    v = v[np.lexsort(v.T[::-1])]
    near = {(i, j) for i in range(len(v)) for j in range(len(v))
            if np.maximum(d := v[j].astype(int) - v[i], 0).sum() <= 1 and np.maximum(-d, 0).sum() <= 1}
    assert {(i, j) for who, j in variants.search(v, v) for i in who.tolist()} == near
    who, where = variants.stretches([x.tobytes() for x in v[::size]], v)
    visits = set(zip(who.tolist(), where.tolist(), strict=True))
    assert {(i, j // size) for i, j in near} <= visits
