from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqframe.functions.text import chars, pad_tokens, tokens
from tests.reference_model import py_chars, py_pad, py_tokens


def _one(spark, col, text):
    df = spark.createDataFrame([(text,)], "t string")
    return df.select(col("t").alias("x")).first()["x"]


def test_chars_edge_rows(spark):
    assert _one(spark, chars, "") == []
    assert len(_one(spark, chars, "aé😀")) == 3
    assert _one(spark, chars, "İ") == ["i", "̇"]
    assert _one(spark, chars, None) is None
    assert _one(spark, chars, "Ab C") == ["a", "b", " ", "c"]


def test_tokens_edge_rows(spark):
    assert _one(spark, tokens, "") == [""]
    assert _one(spark, lambda c: pad_tokens(tokens(c)), "") == [""] + ["<padded>"] * 19
    assert _one(spark, tokens, "a(b)?c") == ["a", "\\(", "b", "\\)", "\\?", "c"]
    assert _one(spark, tokens, "Don't  it's\tx, y!\nz") == [
        "do", "n't", "it", "'s", "x", ",", "y", "!", "z"]
    assert _one(spark, tokens, "IT'S") == ["it's"]
    assert _one(spark, lambda c: pad_tokens(tokens(c)), "Spark is awesome. No really...") == (
        ["spark", "is", "awesome", "no", "really"] + ["<padded>"] * 15)


def test_pad_cuts_long_sequences(spark):
    text = " ".join(f"w{i}" for i in range(30))
    out = _one(spark, lambda c: pad_tokens(tokens(c)), text)
    assert out == [f"w{i}" for i in range(20)]


ALPHABET = st.sampled_from(list("abcXYZ019 '`(),!?.;:-\t\n\"") + ["é", "ß", "😀", "n't", "'s", "'ll"])
TEXTS = st.lists(st.lists(ALPHABET, max_size=40).map("".join), min_size=1, max_size=30)


@settings(max_examples=15, deadline=None)
@given(TEXTS)
def test_tokens_match_plain_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    rows = df.select("i", tokens("t").alias("k"), pad_tokens(tokens("t")).alias("p")).collect()
    for r in rows:
        assert r["k"] == py_tokens(texts[r["i"]])
        assert r["p"] == py_pad(py_tokens(texts[r["i"]]))


@settings(max_examples=10, deadline=None)
@given(TEXTS)
def test_chars_match_plain_python(spark, texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    for r in df.select("i", chars("t").alias("c")).collect():
        assert r["c"] == py_chars(texts[r["i"]])


def test_null_text_stays_null(spark):
    df = spark.createDataFrame([(None,)], "t string")
    r = df.select(tokens("t").alias("k"), F.size(chars("t")).alias("n")).first()
    assert r["k"] is None


def test_positive_class_matches_negated_class():
    import re

    from seqframe.functions.text import TOKEN_RULES, _positive_class

    neg = TOKEN_RULES[0][0]
    pos = _positive_class(neg)
    as_python = re.sub(r"\\x\{([0-9A-F]+)\}", lambda m: "\\U%08x" % int(m.group(1), 16), pos)
    a, b = re.compile(neg), re.compile(as_python)
    for cp in list(range(0, 0x3000)) + [0xD7FF, 0xE000, 0xFFFD, 0x1F600, 0x10FFFF]:
        ch = chr(cp)
        assert bool(a.fullmatch(ch)) == bool(b.fullmatch(ch)), hex(cp)
    assert _positive_class(r"\s{2,}") == r"\s{2,}"


def test_tokens_outside_the_basic_plane(spark):
    # Supplementary-plane characters are single code points for the first
    # rule's class, as in Python.
    for text in ["Hi \U0001F600 there, it's ok!", "x\U00010000y\U0010FFFFz",
                 "émigré's café (déjà) vu?", "Tab\tand nbsp\nline"]:
        assert _one(spark, tokens, text) == py_tokens(text)
