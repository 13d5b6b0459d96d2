from seqframe.operators import batches as B
from seqframe.operators.buckets import assign_buckets


def _bucketed(spark, per_bucket):
    """per_bucket: {length: rows}; each row's X has that length."""
    data, rid = [], 0
    for length, n in per_bucket.items():
        for _ in range(n):
            data.append((rid, list(range(length)), rid % 4))
            rid += 1
    df = spark.createDataFrame(data, "row_id long, X array<int>, Y int").repartition(3)
    return assign_buckets(df, "X", [4, 8, 16])


def test_small_bucket_gives_no_batch(spark):
    b = _bucketed(spark, {3: 11})
    assert B.batch_rows(b, 12).count() == 0


def test_remainder_left_out(spark):
    b = _bucketed(spark, {3: 25})
    rows = B.batch_rows(b, 12).collect()
    assert len(rows) == 24
    assert sorted({r["batch"] for r in rows}) == [0, 1]
    assert len({r["row_id"] for r in rows}) == 24


def test_batch_invariants(spark):
    b = _bucketed(spark, {3: 130, 6: 31, 12: 7})
    sizes = B.bucket_sizes(b)
    rows = B.batch_rows(b, 12, seed=1, epoch=0, keep=["X", "Y"], sizes=sizes)
    order = B.batch_order(spark, sizes, 12, seed=1, epoch=0)
    batches = B.assemble_batches(rows, order).collect()
    assert len(batches) == 130 // 12 + 31 // 12
    assert sorted(r["batch_seq"] for r in batches) == list(range(len(batches)))
    seen = set()
    for r in batches:
        assert r["n_rows"] == 12 and len(r["X"]) == 12
        assert all(len(x) == r["bucket"] == r["seq_len"] for x in r["X"])
        assert not seen & set(r["row_ids"])
        seen |= set(r["row_ids"])
        assert r["Y"] == [rid % 4 for rid in r["row_ids"]]


def _assignment(rows):
    return {r["row_id"]: (r["bucket"], r["batch"]) for r in rows.collect()}


def test_seed_and_epoch(spark):
    b = _bucketed(spark, {3: 100})
    first = _assignment(B.batch_rows(b, 10, seed=3, epoch=0))
    assert first == _assignment(B.batch_rows(b.repartition(9), 10, seed=3, epoch=0))
    assert first != _assignment(B.batch_rows(b, 10, seed=3, epoch=1))
    o0 = B.batch_order(spark, {4: 100}, 10, seed=3, epoch=0).collect()
    o1 = B.batch_order(spark, {4: 100}, 10, seed=3, epoch=1).collect()
    assert {(r["batch"], r["batch_seq"]) for r in o0} != {(r["batch"], r["batch_seq"]) for r in o1}


def test_batches_per_epoch_counts(spark):
    b = _bucketed(spark, {3: 11, 6: 11, 12: 3})
    r = B.batches_per_epoch(b, 12, [4, 8, 16]).first()
    assert (r["naive"], r["actual"]) == (2, 0)


def test_fixed_batches_in_order_with_pad(spark):
    df = spark.createDataFrame([(i * 3,) for i in range(25)], "row_id long").repartition(4)
    out = B.fixed_batches(df, 10, shuffle=False, last_batch="pad").orderBy("batch", "slot").collect()
    assert len(out) == 30
    assert [r["row_id"] for r in out[:20]] == [i * 3 for i in range(20)]
    last = out[20:]
    assert [r["row_id"] for r in last] == [i * 3 for i in range(20, 25)] + [i * 3 for i in range(5)]
    assert {r["pad"] for r in last} == {5} and {r["pad"] for r in out[:20]} == {0}


def test_fixed_batches_shuffled_discard(spark):
    df = spark.createDataFrame([(i,) for i in range(25)], "row_id long")
    out = B.fixed_batches(df, 10, shuffle=True, seed=5, last_batch="discard").collect()
    assert len(out) == 20 and {r["batch"] for r in out} == {0, 1}
    assert sorted(r["slot"] for r in out if r["batch"] == 0) == list(range(10))
    assert [r["row_id"] for r in sorted(out, key=lambda r: (r["batch"], r["slot"]))] != list(range(20))


def test_shuffle_key_matches_python_md5(spark):
    import hashlib
    df = spark.createDataFrame([(7,)], "row_id long")
    got = df.select(B.shuffle_key(42, 0, "row_id")).first()[0]
    assert got == hashlib.md5(b"42|0|7").hexdigest()


def test_default_bucket_key_and_layout(spark):
    from seqframe.operators.batches import batch_layout, default_bucket_key

    sizes = [64, 32, 1024, 128]
    assert default_bucket_key(sizes) == 1024 and sizes == [64, 32, 1024, 128]
    b = spark.createDataFrame([(0, 3, 64), (0, 0, 32)], "epoch int, batch_seq long, bucket int")
    rows = {r["batch_seq"]: r for r in batch_layout(b, 12, sizes).collect()}
    assert rows[3]["data_shape"] == [12, 64] and rows[3]["label_shape"] == [12]
    assert rows[0]["data_shape"] == [12, 32] and rows[0]["default_bucket_key"] == 1024


def test_padding_repeats_the_order_until_the_batch_is_full(spark):
    for n in (1, 3, 8, 0):
        df = spark.range(n).withColumnRenamed("id", "row_id")
        for shuffle in (False, True):
            out = B.fixed_batches(df, 8, shuffle=shuffle, last_batch="pad").orderBy("slot").collect()
            assert [r["slot"] for r in out] == (list(range(8)) if n else [])
            ids = [r["row_id"] for r in out]
            assert ids == [ids[q % n] for q in range(len(ids))]
            assert {r["pad"] for r in out} == ({8 - n} if n else set())


def test_first_batch_is_the_first_of_all(spark):
    from seqframe.plans.character import character_batches

    df = _bucketed(spark, {3: 40, 6: 31}).select("row_id", "X", "Y", "length")
    every = character_batches(df, 12, [4, 8, 16]).where("batch_seq = 0").collect()
    assert len(every) == 1 and every == character_batches(df, 12, [4, 8, 16], first_only=True).collect()
