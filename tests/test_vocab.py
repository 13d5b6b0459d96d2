import random

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from seqframe.operators.vocab import build_label_vocab, build_vocab, freeze_small_vocab, vocab_head
from tests.reference_model import py_vocab


def _vocab_rows(v):
    return [tuple(r) for r in v.orderBy("idx").collect()]


def test_cap_and_first_seen_tie(spark):
    df = spark.createDataFrame([(0, ["b", "c", "a", "b"])], "row_id long, s array<string>")
    assert _vocab_rows(build_vocab(df, "s", cap=2)) == [(0, "b", 2), (1, "c", 1)]


def test_ties_follow_row_then_position(spark):
    df = spark.createDataFrame(
        [(5, ["x", "y"]), (2, ["z", "y"]), (9, ["q"]), (3, [])], "row_id long, s array<string>")
    # row 2 comes first: z (pos 0), y (pos 1); then row 5: x; then row 9: q
    assert _vocab_rows(build_vocab(df, "s")) == [(0, "y", 2), (1, "z", 1), (2, "x", 1), (3, "q", 1)]


def test_huge_row_ids_use_exact_fallback(spark):
    big = 1 << 50
    df = spark.createDataFrame(
        [(big + 1, ["a", "b"]), (big, ["b", "a"]), (7, ["c"])], "row_id long, s array<string>")
    assert _vocab_rows(build_vocab(df, "s")) == [(0, "b", 2), (1, "a", 2), (2, "c", 1)]


def test_empty_and_null_sequences_add_nothing(spark):
    df = spark.createDataFrame([(0, []), (1, None), (2, ["a"])], "row_id long, s array<string>")
    assert _vocab_rows(build_vocab(df, "s")) == [(0, "a", 1)]


SEQS = st.lists(st.lists(st.sampled_from("abcdefghij"), max_size=12), min_size=1, max_size=40)


@settings(max_examples=12, deadline=None)
@given(SEQS, st.one_of(st.none(), st.integers(0, 6)))
def test_matches_counter_most_common(spark, seqs, cap):
    df = spark.createDataFrame(list(enumerate(seqs)), "row_id long, s array<string>")
    assert _vocab_rows(build_vocab(df, "s", cap=cap)) == py_vocab(seqs, cap)


def test_uncapped_numbering_spans_partitions(spark):
    rnd = random.Random(3)
    seqs = [[f"t{rnd.randint(0, 400)}" for _ in range(rnd.randint(0, 15))] for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(seqs)), "row_id long, s array<string>").repartition(5)
    assert _vocab_rows(build_vocab(df, "s")) == py_vocab(seqs, None)


def test_label_vocab_skips_nulls(spark):
    df = spark.createDataFrame(
        [(0, "B"), (1, None), (2, "A"), (3, "A"), (4, None), (5, "B"), (6, "C")],
        "row_id long, label string")
    assert _vocab_rows(build_label_vocab(df, cap=None)) == [(0, "B", 2), (1, "A", 2), (2, "C", 1)]
    assert _vocab_rows(build_label_vocab(df, cap=1)) == [(0, "B", 2)]


def test_head_and_freeze(spark):
    df = spark.createDataFrame([(0, list("aabbbc"))], "row_id long, s array<string>")
    v = freeze_small_vocab(build_vocab(df, "s", cap=10), 10)
    assert [r["term"] for r in vocab_head(v, 2).collect()] == ["b", "a"]
    assert v.schema.simpleString() == "struct<idx:int,term:string,n:bigint>"
    assert v.where(F.col("idx") == 2).first()["term"] == "c"


def test_term_of_broadcast_and_split_paths(spark):
    from seqframe.operators.vocab import term_of
    v = spark.createDataFrame([(0, "a", 5), (1, "b", 3), (2, "c", 1)], "idx int, term string, n long")
    df = spark.createDataFrame([(0, 2), (1, -1), (2, 0), (3, 1), (4, None)], "r int, idx int")
    want = {0: "c", 1: None, 2: "a", 3: "b", 4: None}
    for kw in ({}, {"broadcast_max_terms": 0, "hot_terms": 1}):
        got = {row["r"]: row["term"] for row in term_of(v, "idx", df, **kw).collect()}
        assert got == want


def test_literal_vocab_keeps_awkward_terms(spark):
    from seqframe.operators.vocab import literal_vocab

    rows = [(0, '"', 9), (1, "\\", 8), (2, "\n", 7), (3, "\U0001F600", 6), (4, "", 5),
            (5, None, 4), (6, "'s", 3), (7, "\\(", 2)]
    out = literal_vocab(spark, rows)
    assert out.schema.simpleString() == "struct<idx:int,term:string,n:bigint>"
    assert sorted(tuple(r) for r in out.collect()) == rows
