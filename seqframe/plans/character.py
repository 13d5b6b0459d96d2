"""Character path: labels -> capped character vocabulary -> X, Y -> buckets -> batches.

``prepare_characters`` is fit-on-train / transform-both; ``preprocess_csv``
is the whole preprocessing job from CSV files to parquet tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.ml.feature import HashingTF, VectorAssembler
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.functions.labels import with_label_names
from seqframe.functions.text import DEFAULT_BUCKETS, chars, validated_buckets
from seqframe.operators.batches import (
    assemble_batches,
    batch_order,
    batch_rows,
    bucket_sizes,
    epoch_orders,
    epoch_rows,
)
from seqframe.operators.buckets import bucket_lengths
from seqframe.operators.index import (
    ARRAY_MAX_TERMS,
    index_characters_with_terms,
    index_labels,
    index_sequences,
    index_with_terms,
)
from seqframe.operators.features import DEFAULT_HASH_SLOTS, ngram_featurizer, ngram_stages
from seqframe.operators.model import fit_features
from seqframe.operators.predict import predict_proba
from seqframe.operators.vocab import (
    build_label_vocab,
    build_vocab,
    freeze_small_vocab,
    literal_vocab,
    small_terms,
)
from seqframe.session import materialize, scratch_dir
from seqframe.sources.csv import store_labelled_csv
from seqframe.sources.sinks import write_frame, write_vocab

# The vocabulary cap of the character path (characters and labels).
CHAR_CAP = 200
# Vocabularies up to this size are kept as a literal table, larger ones are checkpointed.
LITERAL_MAX_TERMS = 10_000
# Character n-gram sizes of the character-path classifier.  The classifier
# caches its training rows; with n = 1, 2 a row holds about 200 active features
# (about the size of its text), with trigrams added about 720 (3.6x the text).
CHAR_NGRAMS = (1, 2)


@dataclass
class Prepared:
    train: DataFrame
    test: DataFrame
    vocab: DataFrame
    label_vocab: DataFrame


Splitter = Callable[[Column], Column]


def fit_character_vocab(train: DataFrame, cap: int = CHAR_CAP, text_col: str = "description",
                        row_col: str = "row_id", splitter: Splitter = chars) -> DataFrame:
    """Capped vocabulary of ``splitter(text)`` elements (characters by default)."""
    vocab = build_vocab(train.select(row_col, splitter(F.col(text_col)).alias("_c")), "_c", row_col,
                        cap)
    return freeze_small_vocab(vocab, cap) if cap <= LITERAL_MAX_TERMS else materialize(vocab)


def fit_label_vocab(train: DataFrame, cap: int | None = CHAR_CAP, label_col: str = "label",
                    row_col: str = "row_id", literal_max: int = LITERAL_MAX_TERMS) -> DataFrame:
    """Label vocabulary: a small local table up to ``literal_max`` labels, else a checkpointed one.

    The bounded top-n path with ``literal_max + 1`` entries decides which, and has
    the whole vocabulary in the first case.
    """
    limit = literal_max + 1 if cap is None else min(cap, literal_max + 1)
    head = build_label_vocab(train, label_col, row_col, limit).collect()
    if len(head) <= literal_max:
        return literal_vocab(train.sparkSession, sorted(tuple(r) for r in head))
    return materialize(build_label_vocab(train, label_col, row_col, cap))


def index_characters(df: DataFrame, vocab: DataFrame, label_vocab: DataFrame,
                     text_col: str = "description", label_col: str = "label",
                     splitter: Splitter = chars, row_col: str = "row_id") -> DataFrame:
    """Add ``X``, ``Y`` and ``length`` (elements per text, known before indexing)."""
    with_chars = df.withColumn("_c", splitter(F.col(text_col)))
    length = F.when(F.col("_c").isNotNull(), F.size("_c")).alias("length")
    terms = small_terms(vocab, ARRAY_MAX_TERMS)
    if terms is not None:
        index = index_characters_with_terms if splitter is chars else index_with_terms
        x = with_chars.select(*df.columns, index("_c", terms).alias("X"), length)
    else:  # the text does not travel through the lookup
        x = df.join(index_sequences(with_chars.select(row_col, "_c", length), "_c", vocab, out="X",
                                    row_col=row_col, method="join"), row_col).select(
            *df.columns, "X", "length")
    return index_labels(x, label_vocab, label_col, "Y")


def prepare_characters(train: DataFrame, test: DataFrame, cap: int = CHAR_CAP,
                       text_col: str = "description", label_col: str = "label",
                       row_col: str = "row_id", splitter: Splitter = chars) -> Prepared:
    """Fit both vocabularies on ``train``, then add ``X`` and ``Y`` to both frames.

    ``splitter`` is any ``Column -> Column`` producing an array of strings.  A
    vocabulary past the array-lookup bound is joined, which needs unique row ids.
    """
    vocab = fit_character_vocab(train, cap, text_col, row_col, splitter)
    label_vocab = fit_label_vocab(train, cap, label_col, row_col)
    return Prepared(
        index_characters(train, vocab, label_vocab, text_col, label_col, splitter, row_col),
        index_characters(test, vocab, label_vocab, text_col, label_col, splitter, row_col),
        vocab,
        label_vocab,
    )


def preprocess_csv(spark: SparkSession, train_path: str, test_path: str, out_dir: str,
                   cap: int = CHAR_CAP) -> dict[str, str]:
    """CSV -> label names -> fitted vocabularies -> indexed frames, all written as parquet."""
    train, test = (with_label_names(store_labelled_csv(spark, path, scratch_dir(spark, "csv")))
                   for path in (train_path, test_path))
    p = prepare_characters(train, test, cap)
    out = out_dir.rstrip("/")
    return {
        "char_vocab": write_vocab(p.vocab, f"{out}/char_vocab"),
        "label_vocab": write_vocab(p.label_vocab, f"{out}/label_vocab"),
        "train": write_frame(p.train, f"{out}/train"),
        "test": write_frame(p.test, f"{out}/test"),
    }


def character_batches(indexed: DataFrame, batch_size: int = 12,
                      buckets: Sequence[int] = DEFAULT_BUCKETS, seed: int = 42,
                      epoch: int = 0, row_col: str = "row_id",
                      first_only: bool = False) -> DataFrame:
    """One row per full batch of one epoch, with its place ``batch_seq`` in the epoch.

    ``indexed`` should be a written table with ``X``, ``Y`` and ``length``: it is read
    more than once.  Rows are ranked by id and bucket alone; ``X`` and ``Y`` join
    once, for the rows of full batches.  ``first_only`` assembles only the batch
    with ``batch_seq`` 0.
    """
    narrow = bucket_lengths(indexed.select(row_col, "length"), buckets).select(row_col, "bucket")
    sizes = bucket_sizes(narrow)
    rows = batch_rows(narrow, batch_size, seed, epoch, row_col=row_col, sizes=sizes)
    order = batch_order(indexed.sparkSession, sizes, batch_size, seed, epoch)
    if first_only:
        order = order.where(F.col("batch_seq") == 0)
        rows = rows.join(F.broadcast(order.drop("batch_seq")), ["epoch", "bucket", "batch"],
                         "left_semi")  # one batch
    return assemble_batches(rows.join(_cut(indexed, buckets, row_col), row_col), order, row_col=row_col)


def character_epochs(indexed: DataFrame, epochs: Sequence[int], batch_size: int = 12,
                     buckets: Sequence[int] = DEFAULT_BUCKETS, seed: int = 42,
                     row_col: str = "row_id") -> DataFrame:
    """The batches of several epochs, as ``character_batches`` gives them one by one: the table is read
    once for ids and lengths and once for ``X`` and ``Y``, however many the epochs."""
    narrow = materialize(bucket_lengths(indexed.select(row_col, "length"), buckets).select(row_col, "bucket"))
    sizes = bucket_sizes(narrow)
    rows = epoch_rows(narrow, batch_size, epochs, seed, row_col=row_col, sizes=sizes)
    order = epoch_orders(indexed.sparkSession, sizes, batch_size, epochs, seed)
    return assemble_batches(rows.join(_cut(indexed, buckets, row_col), row_col), order, row_col=row_col)


def _cut(indexed: DataFrame, buckets: Sequence[int], row_col: str) -> DataFrame:
    """``(row_col, X, Y)`` with ``X`` cut to the largest bucket: no batch holds more of it, so no more is shuffled."""
    return indexed.select(row_col, F.slice("X", 1, validated_buckets(buckets)[-1]).alias("X"), "Y")


def _index_strings(df: DataFrame, row_col: str, x_col: str = "X") -> DataFrame:
    """``(row_col, Y, S)``: the character indices as strings, [] for a null text."""
    s = F.coalesce(F.transform(x_col, lambda x: x.cast("string")), F.array().cast("array<string>"))
    return df.select(row_col, "Y", s.alias("S"))


def distinct_grams(x: Column, n: int) -> Column:
    """Distinct ``n``-grams (``n`` 1 or 2) of an index array as ``pyspark.ml``'s NGram writes them; [] for null.

    Grams are told apart as numbers (a pair is one long), so only the distinct ones become text.
    """
    if n == 1:
        out = F.array_distinct(x).cast("array<string>")
    elif n == 2:
        last = F.greatest(F.size(x) - 1, F.lit(0))
        pairs = F.array_distinct(F.zip_with(
            F.slice(x, 1, last), F.slice(x, 2, last),
            lambda a, b: F.shiftleft(a.cast("long"), 32) + (b.cast("long") + F.lit(1 << 31))))
        out = F.transform(pairs, lambda p: F.concat_ws(
            " ", F.shiftright(p, 32).cast("string"),
            (p.bitwiseAND(F.lit((1 << 32) - 1)) - F.lit(1 << 31)).cast("string")))
    else:
        raise ValueError(f"n is 1 or 2, not {n}")
    return F.coalesce(out, F.array().cast("array<string>"))


def character_features(df: DataFrame, row_col: str = "row_id", ns: Sequence[int] = CHAR_NGRAMS,
                       num_features: int = DEFAULT_HASH_SLOTS) -> DataFrame:
    """``(row_col, Y, features)`` of prepared rows: the vectors of ``ngram_stages`` on the index strings.

    The features are binary, so the distinct n-grams of a row give the same vector as all of them.
    """
    if not set(ns) <= {1, 2}:  # longer n-grams do not fit a number
        stages = ngram_featurizer("S", ns, num_features)
        strings = _index_strings(df, row_col)
        return stages.fit(strings).transform(strings).select(row_col, "Y", "features")
    grams = df.select(row_col, "Y", *[distinct_grams(F.col("X"), n).alias(f"_grams{n}") for n in ns])
    for n in ns:
        grams = HashingTF(inputCol=f"_grams{n}", outputCol=f"_hashed{n}", numFeatures=num_features,
                          binary=True).transform(grams)
    return VectorAssembler(inputCols=[f"_hashed{n}" for n in ns], outputCol="features").transform(
        grams).select(row_col, "Y", "features")


def train_and_score_characters(train: DataFrame, test: DataFrame, label_names: Sequence[str],
                               row_col: str = "row_id", ns: Sequence[int] = CHAR_NGRAMS,
                               num_features: int = DEFAULT_HASH_SLOTS,
                               **fit_args) -> tuple[PipelineModel, DataFrame]:
    """The character training job on prepared rows (``X``, ``Y``): fit the n-gram
    classifier on ``train``, probabilities and top class for ``test``.

    The vectors of both are written once: fitting reads them several times, the texts once.  The model
    returned takes index strings in a column ``S``.
    """
    def stored(df: DataFrame, name: str) -> DataFrame:
        feats = character_features(df, row_col, ns, num_features)
        path = write_frame(feats, scratch_dir(df.sparkSession, name))
        return df.sparkSession.read.schema(feats.schema).parquet(path)

    fitted = fit_features(stored(train, "train-features"), "features", "Y", **fit_args)
    pred = predict_proba(fitted, stored(test, "test-features"), label_names, row_col, keep=["Y"])
    return PipelineModel([*ngram_stages("S", ns, num_features), *fitted.stages]), pred


__all__ = [
    "CHAR_CAP",
    "CHAR_NGRAMS",
    "Prepared",
    "character_batches",
    "character_epochs",
    "character_features",
    "distinct_grams",
    "fit_character_vocab",
    "fit_label_vocab",
    "index_characters",
    "prepare_characters",
    "preprocess_csv",
    "train_and_score_characters",
]

