import os
import tempfile

from pyspark.sql import functions as F

from seqframe.plans.character import fit_character_vocab, fit_label_vocab, index_characters
from seqframe.sources.sinks import write_vocab
from seqframe.streaming import start_indexing
from seqframe.queries import _labelled
from tests.conftest import SF_SMALL


def test_stream_equals_batch(spark):
    d = tempfile.mkdtemp(prefix="seqframe-stream-")
    a = _labelled(spark, SF_SMALL)
    train = a.where(F.col("split") == "train")
    v, lv = fit_character_vocab(train, 40), fit_label_vocab(train, 200)
    write_vocab(v, os.path.join(d, "v"))
    write_vocab(lv, os.path.join(d, "lv"))
    src = a.select(F.col("row_id"), F.lit(None).cast("string").alias("title"),
                   "description", "label")
    # Two arrivals of files in the source folder.
    src.where(F.col("row_id") < 100).write.parquet(os.path.join(d, "in", "part1"))
    src.where(F.col("row_id") >= 100).write.parquet(os.path.join(d, "in", "part2"))
    q = start_indexing(
        spark, os.path.join(d, "in", "*"), os.path.join(d, "out"),
        os.path.join(d, "v"), os.path.join(d, "lv"),
        schema="row_id BIGINT, title STRING, description STRING, label STRING",
        checkpoint_location=os.path.join(d, "ckpt"),
    )
    q.awaitTermination(120)
    got = {r["row_id"]: (r["X"], r["Y"], r["bucket"])
           for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    want = {r["row_id"]: (r["X"], r["Y"]) for r in index_characters(a, v, lv).collect()}
    assert set(got) == set(want)
    assert all(got[k][:2] == want[k] for k in want)


def test_many_labels_on_a_stream_restart_and_repeat(spark):
    """10,000 labels, beyond the array bound: joined per batch, also after a restart and a repeated batch."""
    d = tempfile.mkdtemp(prefix="seqframe-stream-")
    n = 10_000
    rows = spark.range(n + 500).select(
        F.col("id").alias("row_id"), F.concat(F.lit("text é "), F.col("id").cast("string")).alias("description"),
        F.when(F.col("id") % 50 == 7, F.lit(None)).otherwise(
            F.concat(F.lit("label "), F.col("id").cast("string"))).alias("label"))
    train = rows.where(F.col("row_id") < n)
    v, lv = fit_character_vocab(train, 40), fit_label_vocab(train, None)
    write_vocab(v, os.path.join(d, "v"))
    write_vocab(lv, os.path.join(d, "lv"))
    assert lv.count() > 9_000

    def run():
        q = start_indexing(spark, os.path.join(d, "in", "*"), os.path.join(d, "out"), os.path.join(d, "v"),
                           os.path.join(d, "lv"), schema="row_id BIGINT, description STRING, label STRING",
                           checkpoint_location=os.path.join(d, "ckpt"))
        q.awaitTermination(300)
        assert q.exception() is None

    rows.where(F.col("row_id") < 6_000).write.parquet(os.path.join(d, "in", "part1"))
    run()
    rows.where(F.col("row_id") >= 6_000).write.parquet(os.path.join(d, "in", "part2"))
    run()
    # The driver was lost after writing the last batch, before its commit: the batch is repeated.
    last = max((f for f in os.listdir(os.path.join(d, "ckpt", "commits")) if f.isdigit()), key=int)
    for name in (last, f".{last}.crc"):
        os.rename(os.path.join(d, "ckpt", "commits", name), os.path.join(d, "ckpt", f"lost-{name}"))
    run()
    got = {r["row_id"]: (r["X"], r["Y"]) for r in spark.read.parquet(os.path.join(d, "out")).collect()}
    assert spark.read.parquet(os.path.join(d, "out")).count() == n + 500
    want = {r["row_id"]: (r["X"], r["Y"]) for r in index_characters(rows, v, lv).collect()}
    assert got == want and sum(y == -1 for _, y in want.values()) >= 500
