"""Several epochs in one plan equal the epochs one by one."""

from pyspark.sql import functions as F

from seqframe.operators import batches as B
from seqframe.plans import character as C


def rows_of(df):
    return sorted(map(tuple, df.collect()))


def test_epochs_equal_single_epochs_and_differ(spark):
    df = spark.range(137).select(F.col("id").alias("row_id"), F.when(F.col("id") % 3 == 0, 64).when(
        F.col("id") % 3 == 1, 32).cast("int").alias("bucket")).checkpoint()  # a third without a bucket
    sizes = B.bucket_sizes(df)
    many = B.epoch_rows(df, 5, [4, 0, 7], 9, sizes=sizes)
    cols = many.columns
    single = [r for e in (0, 4, 7) for r in rows_of(B.batch_rows(df, 5, 9, e, sizes=sizes).select(*cols))]
    assert rows_of(many) == sorted(single)
    left = B.epoch_rows(df, 5, [0, 4, 7], 9, sizes=sizes, left_out=True).collect()
    by_epoch = {e: frozenset(r["row_id"] for r in left if r["epoch"] == e) for e in (0, 4, 7)}
    assert all(len(x) == sum(n % 5 for n in sizes.values()) for x in by_epoch.values())
    assert len(set(by_epoch.values())) == 3
    seen = {(r["epoch"], r["row_id"]) for r in many.collect()}
    assert all((r["epoch"], r["row_id"]) not in seen for r in left)


def test_orders_of_several_epochs(spark):
    sizes = {32: 23, 64: 4, 128: 60}
    many = rows_of(B.epoch_orders(spark, sizes, 5, [3, 1], 8))
    assert many == sorted(x for e in (1, 3) for x in rows_of(B.batch_order(spark, sizes, 5, 8, e)))
    assert sorted(seq for e, _, _, seq in many if e == 1) == list(range(16))
    assert rows_of(B.epoch_orders(spark, {}, 5, [0, 1])) == rows_of(B.epoch_orders(spark, {32: 3}, 5, [])) == []


def test_sequences_are_cut_to_the_largest_bucket_before_the_join(spark):
    df = spark.createDataFrame([(i, [i] * 9 if i else None, 0, 9) for i in range(12)],
                               "row_id long, X array<int>, Y int, length int")
    batches = C.character_epochs(df, [0, 1], 3, [2, 4])
    plan = batches._jdf.queryExecution().optimizedPlan().toString()
    assert "slice(X" in plan[plan.index("Join"):]
    for r in batches.collect():
        assert [x for x in r["X"]] == [None if i == 0 else [i] * 4 for i in r["row_ids"]]
