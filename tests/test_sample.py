import hashlib

import seqframe.operators.sample as S


def _df(spark, n):
    return spark.createDataFrame([(i, f"t{i}") for i in range(n)], "row_id long, t string").repartition(4)


def _keys(n, seed=42):
    return sorted((hashlib.md5(f"{seed}|{i}".encode()).hexdigest(), i) for i in range(n))


def test_exact_sample_size_and_members(spark):
    n = 1000
    out = S.exact_sample(_df(spark, n), 0.013, seed=42)
    ids = sorted(r["row_id"] for r in out.collect())
    assert len(ids) == 13
    assert ids == sorted(i for _, i in _keys(n)[:13])


def test_exact_sample_refines_histogram(spark, monkeypatch):
    monkeypatch.setattr(S, "_FINAL_CELL_ROWS", 2)
    monkeypatch.setattr(S, "_DIGITS_PER_ROUND", 1)
    out = S.exact_sample(_df(spark, 300), 0.1, seed=42)
    assert sorted(r["row_id"] for r in out.collect()) == sorted(i for _, i in _keys(300)[:30])


def test_sample_size_rounds_half_to_even():
    assert S.sample_size(120000, 0.00005) == 6
    assert S.sample_size(10000, 0.00005) == 0
    assert S.sample_size(30000, 0.00005) == 2


def test_zero_rows(spark):
    assert S.exact_sample(_df(spark, 10), 0.0).count() == 0


def test_first_and_random_row(spark):
    df = _df(spark, 50)
    assert [r["row_id"] for r in S.first_rows(df, 5).collect()] == [0, 1, 2, 3, 4]
    assert S.random_row(df, seed=42).first()["row_id"] == _keys(50)[0][1]
