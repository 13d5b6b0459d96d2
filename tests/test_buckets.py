from seqframe.functions.text import validated_buckets
from seqframe.operators.buckets import assign_buckets, bucket_counts, sliced_count
from tests.reference_model import py_bucket


def _rows(spark, lengths):
    data = [(i, list(range(n))) for i, n in enumerate(lengths)]
    return spark.createDataFrame(data, "row_id long, X array<int>")


def test_bucket_edges(spark):
    lengths = [0, 32, 33, 64, 65]
    out = assign_buckets(_rows(spark, lengths), "X", [64, 32]).orderBy("row_id").collect()
    assert [r["bucket"] for r in out] == [32, 32, 64, 64, 64]
    assert [r["sliced"] for r in out] == [False, False, False, False, True]
    assert out[0]["P"] == [-1] * 32
    assert out[2]["P"] == list(range(33)) + [-1] * 31
    assert out[4]["P"] == list(range(64))
    assert [r["length"] for r in out] == lengths


def test_counts_include_empty_buckets(spark):
    df = assign_buckets(_rows(spark, [1, 2, 100, 2000]), "X", [32, 64, 128, 1024])
    assert sorted(tuple(r) for r in bucket_counts(df, [32, 64, 128, 1024]).collect()) == [
        (32, 2), (64, 0), (128, 1), (1024, 1)]
    assert sliced_count(df).first()[0] == 1


def test_matches_bisect_rule(spark):
    lengths = list(range(0, 300, 7))
    buckets = [16, 50, 128, 256]
    out = assign_buckets(_rows(spark, lengths), "X", buckets).orderBy("row_id").collect()
    assert [r["bucket"] for r in out] == [py_bucket(n, buckets) for n in lengths]


def test_null_sequences_have_no_bucket(spark):
    df = spark.createDataFrame([(0, None)], "row_id long, X array<int>")
    r = assign_buckets(df, "X", [4]).first()
    assert r["bucket"] is None and r["P"] is None


def test_caller_bucket_list_not_mutated():
    b = [64, 32]
    assert validated_buckets(b) == [32, 64] and b == [64, 32]
