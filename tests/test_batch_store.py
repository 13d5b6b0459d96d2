"""The batch store: runs of batches per file, one file for one batch, restarts."""

import pytest
from pyspark.sql import functions as F

from seqframe.sources import batch_store as S


@pytest.fixture
def store(spark, tmp_path):
    batches = spark.range(90).select((F.col("id") % 3).cast("int").alias("epoch"),
                                     F.floor(F.col("id") / 3).alias("batch_seq"),
                                     F.array(F.col("id"), F.col("id") * 2).alias("row_ids")).repartition(7)
    return S.write_batch_store(batches, str(tmp_path / "store"), 90, 8), batches


def test_files_hold_consecutive_batches(spark, store):
    path, _ = store
    runs = S.directory(spark, path).orderBy("epoch", "first").collect()
    assert all(r["last"] - r["first"] + 1 == r["n"] for r in runs) and sum(r["n"] for r in runs) == 90
    assert len({r["file"] for r in runs}) >= 8
    for epoch in range(3):  # without gaps or overlaps
        mine = [r for r in runs if r["epoch"] == epoch]
        assert [r["first"] for r in mine] == [0] + [r["last"] + 1 for r in mine[:-1]]


def test_one_batch_reads_one_file_and_a_restart_the_rest(spark, store):
    path, batches = store
    want = {(r["epoch"], r["batch_seq"]): r["row_ids"] for r in batches.collect()}
    for epoch, k in ((0, 0), (1, 13), (2, 29)):
        one = S.read_batch(spark, path, epoch, k)
        assert len(one.inputFiles()) == 1
        assert [tuple(r) for r in one.collect()] == [(epoch, k, want[epoch, k])]
    all_files = spark.read.parquet(f"{path}/batches").inputFiles()
    rest = S.read_batches(spark, path, 1, 20)
    assert len(rest.inputFiles()) < len(all_files) / 2
    assert {r["batch_seq"]: r["row_ids"] for r in rest.collect()} == {
        k: v for (e, k), v in want.items() if e == 1 and k >= 20}
    assert S.read_batches(spark, path, 0).count() == 30
    assert S.read_batch(spark, path, 0, 30).count() == S.read_batches(spark, path, 9).count() == 0


def test_empty_store(spark, tmp_path):
    empty = spark.createDataFrame([], "epoch int, batch_seq long, row_ids array<long>")
    path = S.write_batch_store(empty, str(tmp_path / "store"), 0)
    assert S.read_batches(spark, path, 0).count() == 0
    with pytest.raises(ValueError):
        S.write_batch_store(empty, str(tmp_path / "other"), 0, 0)


def test_tasks_do_not_follow_the_number_of_files(spark, tmp_path):
    batches = spark.range(90).select((F.col("id") % 3).cast("int").alias("epoch"),
                                     F.floor(F.col("id") / 3).alias("batch_seq"), F.col("id").alias("x")).repartition(7)
    path = S.write_batch_store(batches, str(tmp_path / "store"), 90, 1)
    files = [r["file"] for r in S.directory(spark, path).collect()]
    assert len(set(files)) == 90  # one batch a file, as asked for
    assert len({f.split("-")[1] for f in files}) <= int(spark.conf.get("spark.sql.shuffle.partitions"))
    assert sorted(tuple(r) for e in range(3) for r in S.read_batches(spark, path, e).collect()) == sorted(
        tuple(r) for r in batches.collect())
