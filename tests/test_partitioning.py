"""Results do not depend on how the input or the shuffles are partitioned.

Recomputing a lost partition, or running on a cluster of another size, must
give the same vocabularies, batches and samples: every order comes from data
(counts, row ids, md5 keys), never from arrival order.
"""

from pyspark.sql import functions as F

from seqframe.functions.text import chars
from seqframe.operators.batches import batch_rows, fixed_batches
from seqframe.operators.buckets import assign_buckets
from seqframe.operators.sample import exact_sample
from seqframe.operators.vocab import build_vocab
from tests.conftest import SF_SMALL


def _results(spark, input_parts, shuffle_parts):
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", str(shuffle_parts))
    try:
        docs = (spark.read.parquet(f"{SF_SMALL}/documents.parquet")
                .select(F.col("doc_id").alias("row_id"), chars("text").alias("C"))
                .repartition(input_parts))
        vocab = sorted(tuple(r) for r in build_vocab(docs, "C").collect())
        bucketed = assign_buckets(docs, "C", [256, 1024, 4096]).select("row_id", "bucket")
        rows = sorted(tuple(r) for r in batch_rows(bucketed, 5, seed=3).collect())
        fixed = sorted(tuple(r) for r in fixed_batches(docs.select("row_id"), 7, shuffle=True,
                                                        last_batch="pad").collect())
        sample = sorted(r["row_id"] for r in exact_sample(docs.select("row_id"), 0.3).collect())
        return vocab, rows, fixed, sample
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)


def test_same_results_for_any_partitioning(spark):
    a = _results(spark, 1, 3)
    b = _results(spark, 7, 11)
    assert all(len(x) > 0 for x in a)
    assert a == b
