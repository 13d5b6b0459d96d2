import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from seqframe.operators import batches as B
from seqframe.operators.numbering import dense_index, group_bounds, rank_within, salt_chars_for


def _keyed(spark, n, groups, seed=1):
    rnd = random.Random(seed)
    rows = [(i, rnd.choice(groups)) for i in range(n)]
    df = spark.createDataFrame(rows, "row_id long, g int").repartition(7)
    return df.withColumn("k", F.md5(F.col("row_id").cast("string")))


def _plain(df, parts):
    w = Window.partitionBy(*parts).orderBy("k", "row_id") if parts else Window.orderBy("k", "row_id")
    return {r["row_id"]: r["rn"] for r in df.select("row_id", (F.row_number().over(w) - 1)
                                                     .alias("rn")).collect()}


def test_rank_within_equals_row_number(spark):
    df = _keyed(spark, 2000, [1, 1, 1, 2, 3])  # group 1 holds most rows
    expected = _plain(df, ["g"])
    for salt in (1, 2, 3, 4, 6):  # past three digits the offsets come in two levels
        got = rank_within(df, "k", ["g"], out="rn", tiebreak=["row_id"], salt_chars=salt, total_col="tot")
        rows = got.collect()
        assert {r["row_id"]: r["rn"] for r in rows} == expected
        sizes = {}
        for r in rows:
            sizes[r["g"]] = sizes.get(r["g"], 0) + 1
        assert all(r["tot"] == sizes[r["g"]] for r in rows)


def test_rank_within_global_and_totals(spark):
    df = _keyed(spark, 500, [1])
    got = rank_within(df, "k", (), out="rn", tiebreak=["row_id"], total_col="tot")
    rows = got.collect()
    assert {r["row_id"]: r["rn"] for r in rows} == _plain(df, [])
    assert {r["tot"] for r in rows} == {500}


def test_dense_index_total_order(spark):
    rnd = random.Random(5)
    rows = [(i, rnd.randint(0, 20)) for i in range(1500)]
    df = spark.createDataFrame(rows, "row_id long, n int").repartition(6)
    out = dense_index(df, [F.col("n").desc(), F.col("row_id").asc()], out="idx", num_partitions=9)
    got = {r["row_id"]: r["idx"] for r in out.collect()}
    expected = sorted(rows, key=lambda r: (-r[1], r[0]))
    assert got == {r[0]: i for i, r in enumerate(expected)}


def test_salt_width_grows_with_group_size():
    assert salt_chars_for(10) == 1
    assert salt_chars_for(10**9, 10**6) == 3
    assert salt_chars_for(10**15, 10**6) == 6
    assert salt_chars_for(10, max_group_bytes=300 << 20) == 1
    assert salt_chars_for(10, max_group_bytes=10 << 30) == 2
    assert salt_chars_for(10, target_bytes=1, max_group_bytes=16**4) == 4


def test_two_level_offsets_without_groups(spark):
    df = _keyed(spark, 400, [1])
    got = rank_within(df, "k", (), out="rn", tiebreak=["row_id"], salt_chars=5, total_col="tot").collect()
    assert {r["row_id"]: r["rn"] for r in got} == _plain(df, [])
    assert {r["tot"] for r in got} == {400}


def test_a_bucket_of_few_long_rows_is_cut(spark, monkeypatch):
    rows = [(i, 32, "x") for i in range(300)] + [(1000 + i, 64, "y" * 4000) for i in range(20)] + [
        (2000, 64, None)]
    df = spark.createDataFrame(rows, "row_id long, bucket int, t string")
    size = B.carried_bytes(df, ["t"])
    assert group_bounds(df, ["bucket"], size) == (300, 80_000)
    widths = []
    real = B.rank_within
    monkeypatch.setattr(B, "rank_within", lambda *a, **k: widths.append(k["salt_chars"]) or real(*a, **k))
    plain = sorted(map(tuple, B.batch_rows(df, 10, keep=["t"]).collect()))
    cut = sorted(map(tuple, B.batch_rows(df, 10, keep=["t"], target_group_bytes=100).collect()))
    assert plain == cut and widths == [1, 3]


def test_carried_bytes_of_every_kind(spark):
    df = spark.createDataFrame(
        [(1, "\u00e9a", bytearray(b"xyz"), [1, 2], ["ab", None], None)],
        "i long, s string, b binary, n array<int>, w array<string>, z array<int>")
    assert df.select(B.carried_bytes(df, df.columns)).first()[0] == 8 + 3 + 3 + 16 + 18
