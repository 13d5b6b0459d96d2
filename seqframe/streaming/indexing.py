"""Apply fitted character and label vocabularies to a stream of new rows.

Fitting needs the whole training set and stays a batch job.  Applying small vocabularies is a plain
projection, so it runs unchanged on a streaming DataFrame: no state, no watermark, no shuffle.  Larger
vocabularies are joined, batch by batch (``foreachBatch``), by the same operators as in a batch
job; every batch is written to a folder named by its id and overwritten if the stream repeats it, so a
restart neither loses nor doubles rows.  Either way each micro-batch's output equals the batch
transform of the same rows.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from seqframe.functions.labels import label_name
from seqframe.functions.text import DEFAULT_BUCKETS, bucket_of, chars, pad_to_bucket
from seqframe.operators.index import (
    ARRAY_MAX_TERMS,
    index_label_with_terms,
    index_labels,
    index_sequences,
    index_with_terms,
)
from seqframe.operators.vocab import small_terms
from seqframe.sources.csv import ARTICLE_SCHEMA
from seqframe.sources.parquet import read_vocab


def index_stream(
    df: DataFrame,
    char_terms: Sequence[str],
    label_terms: Sequence[str],
    text_col: str = "description",
    label_col: str = "label",
    buckets: Sequence[int] | None = DEFAULT_BUCKETS,
) -> DataFrame:
    """Add ``X``, ``Y`` and, with ``buckets``, ``length``/``bucket``/``sliced``/``P``."""
    out = df.withColumn("X", index_with_terms(chars(text_col), char_terms)).withColumn(
        "Y", index_label_with_terms(label_col, label_terms)
    )
    return _with_buckets(out, buckets)


def _with_buckets(df: DataFrame, buckets: Sequence[int] | None) -> DataFrame:
    if not buckets:
        return df
    return (
        df.withColumn("length", F.when(F.col("X").isNotNull(), F.size("X")))
        .withColumn("bucket", bucket_of(F.col("length"), buckets))
        .withColumn("sliced", F.col("length") > F.lit(max(buckets)))
        .withColumn("P", pad_to_bucket("X", "bucket"))
    )


def index_batch(df: DataFrame, vocab: DataFrame, label_vocab: DataFrame, text_col: str = "description",
                label_col: str = "label", row_col: str = "row_id",
                buckets: Sequence[int] | None = DEFAULT_BUCKETS, array_max_terms: int = ARRAY_MAX_TERMS,
                **bounds: int) -> DataFrame:
    """The columns of ``index_stream`` for one micro-batch (unique row ids), whatever the vocabularies' sizes."""
    labelled = index_labels(df, label_vocab, label_col, "Y", array_max_terms=array_max_terms, **bounds)
    x = index_sequences(labelled.select(row_col, chars(text_col).alias("_s")), "_s", vocab, "X", row_col,
                        array_max_terms=array_max_terms, **bounds).select(row_col, "X")
    return _with_buckets(labelled.join(x, row_col), buckets)


def start_indexing(
    spark: SparkSession,
    source_dir: str,
    sink_dir: str,
    char_vocab_path: str,
    label_vocab_path: str,
    schema: str = ARTICLE_SCHEMA + ", row_id BIGINT",
    fmt: str = "parquet",
    checkpoint_location: str | None = None,
    available_now: bool = True,
    max_terms: int = ARRAY_MAX_TERMS,
) -> StreamingQuery:
    """File stream of articles -> label names -> indexed rows -> parquet files.

    Vocabularies of at most ``max_terms`` terms are applied as a projection; if one is larger, both are
    joined per micro-batch and the sink has a folder ``batch_id=N`` for each.  ``checkpoint_location`` is
    required: with a new folder each start, a restarted stream would read every file again and append
    duplicates.
    """
    if checkpoint_location is None:
        raise ValueError("checkpoint_location is required")
    vocab, label_vocab = (read_vocab(spark, p) for p in (char_vocab_path, label_vocab_path))
    src = spark.readStream.schema(schema).format(fmt).load(source_dir)
    if "indexed_label" in src.columns:
        src = src.withColumn("label", label_name("indexed_label")).drop("indexed_label")
    char_terms, label_terms = (small_terms(v, max_terms) for v in (vocab, label_vocab))
    if char_terms is not None and label_terms is not None:
        writer = index_stream(src, char_terms, label_terms).writeStream.format("parquet").option(
            "path", sink_dir).outputMode("append")
    else:
        def write(batch: DataFrame, batch_id: int) -> None:
            out = index_batch(batch, vocab, label_vocab, array_max_terms=max_terms)
            out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

        writer = src.writeStream.foreachBatch(write)
    writer = writer.option("checkpointLocation", checkpoint_location)
    writer = writer.trigger(availableNow=True) if available_now else writer
    return writer.start()
