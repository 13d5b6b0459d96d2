"""Registered queries over the driver's tables, and their DuckDB oracle SQL.

Each query takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
whole ``documents`` table (plus ``labels`` / ``conversations`` where noted).
Arrays are reported as text or md5 digests so results compare by value; every
computed column has the same name and type on both sides.

Conventions of the stand-in data (see ``seqframe.sources.testdata``): ``doc_id``
is the row id, ``text`` the description, ``lang`` the label code (en 1, fr 2,
de 3, es 4) and an md5 split key puts about a fifth of the rows in ``test``.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from seqframe.functions.labels import NEWS_LABELS, with_label_names
from seqframe.functions.text import (
    DEFAULT_BUCKETS,
    MAX_TOKENS,
    PAD_TOKEN,
    TOKEN_RULES,
    chars,
    ints_to_string,
    pad_tokens,
    tokens,
)
from seqframe.operators import batches as B
from seqframe.operators.buckets import assign_buckets, bucket_counts, bucket_lengths, sliced_count
from seqframe.operators.evaluate import accuracy
from seqframe.operators.features import DEFAULT_NGRAMS, ngram_featurizer
from seqframe.operators.index import index_labels
from seqframe.operators import linear as L
from seqframe.operators.ngrams import gram_dictionary, gram_indices, gram_rows, index_grams
from seqframe.operators.numbering import dense_index
from seqframe.operators.predict import predict_texts
from seqframe.operators.sample import exact_sample, first_rows, random_row
from seqframe.operators.vocab import build_label_vocab, term_of, vocab_head
from seqframe.plans import character as C
from seqframe.plans import token as T
from seqframe.session import materialize, scratch_dir
from seqframe.sources.batch_store import read_batch, read_batches, write_batch_store
from seqframe.sources.csv import read_checked_csv, read_headered_csv
from seqframe.sources.parquet import read_frame, read_vocab
from seqframe.sources.sinks import write_csv, write_frame, write_vocab
from seqframe.sources.testdata import (
    LANG_CODES,
    SPLIT_SEED,
    articles,
    lang_code,
    split_of,
    split_threshold,
    table,
)

# Parameters of the registered queries.
CHAR_CAP = C.CHAR_CAP  # the character path's cap
SMALL_CHAR_CAP = 40  # below the ~65 distinct characters, so unseen (-1) occurs
LABEL_CHARS = 12
BATCH = 12
TOKEN_BATCH = 120
SEED = 42
EPOCH = 0
EPOCHS = [0, 1, 2]
STORE_FILE = 16  # batches to a file
RESTART = 5
GRAM_MIN_DF = 2
STEPS = 3
RATE = 4.0
L2 = 0.001
SAMPLE_FRACTION = 0.005
UNSEEN_TERM = "<unseen>"  # cannot be a token: the first rule removes "<" and ">"


# --------------------------------------------------------------------------
# Spark side
# --------------------------------------------------------------------------

def _labelled(spark: SparkSession, sf_dir: str) -> DataFrame:
    return with_label_names(articles(spark, sf_dir))


def _train(spark, sf_dir):
    return _labelled(spark, sf_dir).where(F.col("split") == "train")


def _char_prepared(spark, sf_dir, cap):
    a = _labelled(spark, sf_dir)
    train = a.where(F.col("split") == "train")
    vocab = C.fit_character_vocab(train, cap)
    label_vocab = C.fit_label_vocab(train, cap)
    return C.index_characters(a, vocab, label_vocab), vocab, label_vocab


def q_char_vocab(spark, sf_dir):
    return C.fit_character_vocab(_train(spark, sf_dir), CHAR_CAP)


def q_char_vocab_cap40(spark, sf_dir):
    return C.fit_character_vocab(_train(spark, sf_dir), SMALL_CHAR_CAP)


def q_token_vocab(spark, sf_dir):
    return T.fit_token_vocab(_train(spark, sf_dir))


def q_label_vocab(spark, sf_dir):
    return build_label_vocab(_train(spark, sf_dir), "label", "row_id", CHAR_CAP)


def q_vocab_size(spark, sf_dir):
    """One row per vocabulary: its number of entries."""
    train = _train(spark, sf_dir)

    def size_of(name, terms, cap=None):
        n = F.count(F.lit(1))
        return terms.agg(F.lit(name).alias("vocab"),
                         (F.least(n, F.lit(cap)) if cap else n).cast("long").alias("terms"))

    def terms_of(seq):
        return train.select(F.explode_outer(seq).alias("term")).where("term is not null").distinct()

    return (
        size_of("char", terms_of(chars("description")), CHAR_CAP)
        .unionByName(size_of("token", terms_of(pad_tokens(tokens("description")))))
        .unionByName(size_of("label", train.where("label is not null").select("label").distinct()))
    )


def q_vocab_top10(spark, sf_dir):
    return vocab_head(T.fit_token_vocab(_train(spark, sf_dir), cap=10), 10)


def q_label_names(spark, sf_dir):
    a = _labelled(spark, sf_dir)
    return a.select(F.col("row_id").alias("doc_id"), "label")


def q_chars(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    c = chars("text")
    return d.select(
        "doc_id",
        F.size(c).cast("long").alias("n_chars"),
        F.md5(F.array_join(c, "\u0001")).alias("chars_md5"),
    )


def q_tokens(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = tokens("text")
    return d.select("doc_id", F.size(t).cast("long").alias("n_tokens"),
                    F.array_join(t, "|").alias("tokens"))


def q_tokens_padded(spark, sf_dir):
    d = table(spark, sf_dir, "documents")
    t = pad_tokens(tokens("text"))
    return d.select("doc_id", F.size(t).cast("long").alias("n_tokens"),
                    F.array_join(t, "|").alias("tokens"))


def q_char_index(spark, sf_dir):
    idx, _, _ = _char_prepared(spark, sf_dir, SMALL_CHAR_CAP)
    return idx.select(
        F.col("row_id").alias("doc_id"), "split", "label", "Y",
        F.size("X").cast("long").alias("n_x"), ints_to_string("X").alias("X"),
    )


def q_label_index(spark, sf_dir):
    a = _labelled(spark, sf_dir).select("row_id", "split", "label")
    label_vocab = C.fit_label_vocab(a.where(F.col("split") == "train"), CHAR_CAP)
    out = index_labels(a, label_vocab, "label", "Y")
    return out.select(F.col("row_id").alias("doc_id"), "split", "label", "Y")


def q_label_index_many(spark, sf_dir):
    """Many labels, without a cap: the first characters of each text."""
    a = articles(spark, sf_dir).select(
        "row_id", "split", F.substring("description", 1, LABEL_CHARS).alias("label"))
    label_vocab = C.fit_label_vocab(a.where(F.col("split") == "train"), None)
    out = index_labels(a, label_vocab, "label", "Y")
    return out.select(F.col("row_id").alias("doc_id"), "split", "label", "Y")


def q_label_index_missing(spark, sf_dir):
    """Labels from the partial ``labels`` table: documents without one get null, Y = -1."""
    docs = table(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"))
    lab = table(spark, sf_dir, "labels").select(
        F.col("doc_id").alias("row_id"), (F.col("quality") + 1).alias("indexed_label"))
    a = with_label_names(docs.join(lab, on="row_id", how="left")).withColumn(
        "split", split_of("row_id"))
    label_vocab = C.fit_label_vocab(a.where(F.col("split") == "train"), CHAR_CAP)
    out = index_labels(a, label_vocab, "label", "Y")
    return out.select(F.col("row_id").alias("doc_id"), "split", "label", "Y")


def _token_indexed(spark, sf_dir, carry=()):
    """All rows tokenized once; vocabularies fitted on the train rows of that table."""
    t = T.tokenized(_labelled(spark, sf_dir))
    train = t.where(F.col("split") == "train")  # a stored column of the checkpoint
    vocab = T.fit_vocab_from_tokens(train)
    label_vocab = C.fit_label_vocab(train, None)
    return T.index_token_frame(t, vocab, label_vocab, carry=carry), vocab


def q_token_index(spark, sf_dir):
    idx, _ = _token_indexed(spark, sf_dir, carry=("split",))
    return idx.select(F.col("row_id").alias("doc_id"), "split", "label", "Y",
                      ints_to_string("X").alias("X"))


def _lengths(spark, sf_dir, split="train"):
    """``(row_id, bucket, sliced)``: bucket counts and orders need lengths only, no vocabulary."""
    a = articles(spark, sf_dir).where(F.col("split") == split)
    return bucket_lengths(a.select("row_id", F.size(chars("description")).alias("_n")).select(
        "row_id", F.when(F.col("_n") >= 0, F.col("_n")).alias("length")), DEFAULT_BUCKETS)


def q_bucket_assign(spark, sf_dir):
    idx, _, _ = _char_prepared(spark, sf_dir, SMALL_CHAR_CAP)
    b = assign_buckets(idx, "X", DEFAULT_BUCKETS, length_col="length")
    return b.select(F.col("row_id").alias("doc_id"), "length", "bucket", "sliced",
                    F.md5(ints_to_string("P")).alias("P_md5"))


def q_bucket_counts(spark, sf_dir):
    return bucket_counts(_lengths(spark, sf_dir), DEFAULT_BUCKETS)


def q_bucket_counts_test(spark, sf_dir):
    return bucket_counts(_lengths(spark, sf_dir, "test"), DEFAULT_BUCKETS)


def _both_splits(of: Callable[[str], DataFrame]) -> DataFrame:
    """Rows of ``of("train")`` and ``of("test")`` with a ``split`` column."""
    train, test = (of(s).withColumn("split", F.lit(s)) for s in ("train", "test"))
    return train.unionByName(test)


def q_sliced_count(spark, sf_dir):
    return _both_splits(lambda split: sliced_count(_lengths(spark, sf_dir, split)))


def q_batch_rows(spark, sf_dir):
    def rows(split):
        b = materialize(_lengths(spark, sf_dir, split).select("row_id", "bucket"))
        return B.batch_rows(b, BATCH, SEED, EPOCH, sizes=B.bucket_sizes(b))

    return _both_splits(rows).select("split", "epoch", "bucket", "batch", F.col("row_id").alias("doc_id"), "rank")


def _order(spark, sf_dir, split):
    return B.batch_order(spark, B.bucket_sizes(_lengths(spark, sf_dir, split)), BATCH, SEED, EPOCH)


def q_batch_order(spark, sf_dir):
    return _both_splits(lambda split: _order(spark, sf_dir, split))


def q_bucket_counts_split(spark, sf_dir):
    """Rows per bucket of both splits: the flagship query."""
    return _both_splits(lambda split: bucket_counts(_lengths(spark, sf_dir, split), DEFAULT_BUCKETS))


def _batches(spark, sf_dir, split="train", first_only=False):
    """Batches of a split's indexed rows, written once: batching reads them twice."""
    idx, _, _ = _char_prepared(spark, sf_dir, SMALL_CHAR_CAP)
    rows = idx.where(F.col("split") == split).select("row_id", "X", "Y", "length")
    path = write_frame(rows, scratch_dir(spark, "indexed"))
    return C.character_batches(read_frame(spark, path), BATCH, DEFAULT_BUCKETS, SEED, EPOCH,
                               first_only=first_only)


def _batch_report(b: DataFrame) -> DataFrame:
    return b.select(
        "epoch", "batch_seq", "bucket", F.col("n_rows").cast("long").alias("n_rows"),
        F.col("seq_len").cast("int").alias("seq_len"),
        F.array_join(F.transform("row_ids", lambda r: r.cast("string")), ",").alias("row_ids"),
        ints_to_string("Y").alias("Y"),
        F.md5(F.array_join(F.transform("X", lambda x: ints_to_string(x)), ";")).alias("X_md5"),
    )


def q_batches(spark, sf_dir):
    return _batch_report(_batches(spark, sf_dir))


def q_batches_test(spark, sf_dir):
    return _batch_report(_batches(spark, sf_dir, "test"))


def _indexed_split(spark, sf_dir, split="train"):
    idx, _, _ = _char_prepared(spark, sf_dir, SMALL_CHAR_CAP)
    rows = idx.where(F.col("split") == split).select("row_id", "X", "Y", "length")
    return read_frame(spark, write_frame(rows, scratch_dir(spark, "indexed")))


def q_batches_epochs(spark, sf_dir):
    """Batches of several epochs from one plan."""
    return _batch_report(C.character_epochs(_indexed_split(spark, sf_dir), EPOCHS, BATCH, DEFAULT_BUCKETS,
                                            SEED))


def _batch_store(spark, sf_dir):
    indexed = _indexed_split(spark, sf_dir)
    batches = C.character_epochs(indexed, EPOCHS, BATCH, DEFAULT_BUCKETS, SEED)
    sizes = B.bucket_sizes(bucket_lengths(indexed.select("row_id", "length"), DEFAULT_BUCKETS))
    n = len(EPOCHS) * sum(x // BATCH for x in sizes.values())
    return write_batch_store(batches, scratch_dir(spark, "batches"), n, STORE_FILE)


def q_batch_restart(spark, sf_dir):
    """A stored epoch from one of its batches to the end."""
    return _batch_report(read_batches(spark, _batch_store(spark, sf_dir), EPOCHS[1], RESTART))


def q_batch_at(spark, sf_dir):
    """One stored batch of an epoch."""
    return _batch_report(read_batch(spark, _batch_store(spark, sf_dir), EPOCHS[2], RESTART))


def q_left_out_rows(spark, sf_dir):
    """Rows that fill no whole batch, per epoch: others in each."""
    b = materialize(_lengths(spark, sf_dir).select("row_id", "bucket"))
    r = B.epoch_rows(b, BATCH, EPOCHS, SEED, left_out=True)
    return r.select("epoch", "bucket", F.col("row_id").alias("doc_id"), "rank")


def q_batch_layout(spark, sf_dir):
    lay = _both_splits(lambda split: B.batch_layout(_order(spark, sf_dir, split), BATCH, DEFAULT_BUCKETS))
    return lay.select("split", "epoch", "batch_seq", "bucket",
                      F.array_join("data_shape", ",").alias("data_shape"),
                      F.array_join("label_shape", ",").alias("label_shape"),
                      "default_bucket_key")


def q_first_batch(spark, sf_dir):
    return _both_splits(lambda split: _batch_report(_batches(spark, sf_dir, split, first_only=True)))


def q_batches_per_epoch(spark, sf_dir):
    return _both_splits(
        lambda split: B.batches_per_epoch(_lengths(spark, sf_dir, split), BATCH, DEFAULT_BUCKETS))


def q_fixed_batches_train(spark, sf_dir):
    train = _train(spark, sf_dir)
    # The fixed-size iterator completes its last batch by default.
    fb = B.fixed_batches(train, TOKEN_BATCH, shuffle=True, seed=SEED, epoch=EPOCH,
                         last_batch="pad")
    return fb.select("epoch", "batch", "slot", F.col("row_id").alias("doc_id"), "pad")


def q_fixed_batches_train_discard(spark, sf_dir):
    train = _train(spark, sf_dir)
    fb = B.fixed_batches(train, TOKEN_BATCH, shuffle=True, seed=SEED, epoch=EPOCH,
                         last_batch="discard")
    return fb.select("epoch", "batch", "slot", F.col("row_id").alias("doc_id"), "pad")


def q_fixed_batches_test(spark, sf_dir):
    test = _labelled(spark, sf_dir).where(F.col("split") == "test")
    fb = B.fixed_batches(test, TOKEN_BATCH, shuffle=False, last_batch="pad")
    return fb.select("epoch", "batch", "slot", F.col("row_id").alias("doc_id"), "pad")


def q_first_rows(spark, sf_dir):
    a = _labelled(spark, sf_dir)
    return first_rows(a, 5).select(F.col("row_id").alias("doc_id"), "label", "split")


def q_sample_exact(spark, sf_dir):
    a = _labelled(spark, sf_dir)
    return exact_sample(a, SAMPLE_FRACTION, SEED).select(
        F.col("row_id").alias("doc_id"), "label", "split")


def q_random_row(spark, sf_dir):
    a = _labelled(spark, sf_dir).where(F.col("split") == "test")
    return random_row(a, SEED).select(F.col("row_id").alias("doc_id"), "label",
                                      F.col("description").alias("text"))


def q_csv_round_trip(spark, sf_dir):
    d = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    path = write_csv(d, scratch_dir(spark, "csv"))
    # By name: the file has the columns in another order.
    back = read_headered_csv(spark, path, "lang STRING, doc_id BIGINT, text STRING")
    return back.drop("row_id")


def _csv_job(spark, sf_dir):
    """The preprocessing job on headerless CSV files in row order; the title carries the row id."""
    a = articles(spark, sf_dir)
    base = scratch_dir(spark, "csvjob")
    for split in ("train", "test"):
        rows = a.where(F.col("split") == split).repartitionByRange("row_id").sortWithinPartitions(
            "row_id").select("indexed_label", F.col("row_id").cast("string").alias("title"),
                             "description")
        write_csv(rows, f"{base}/{split}", header=False)
    return C.preprocess_csv(spark, f"{base}/train", f"{base}/test", f"{base}/out", SMALL_CHAR_CAP)


def _checked_csv(spark, sf_dir):
    """Documents as headerless CSV in which some rows have a bad code, a field too many or one too few."""
    d = table(spark, sf_dir, "documents")
    quoted = F.concat(F.lit('"'), F.replace("text", F.lit('"'), F.lit('""')), F.lit('"'))
    code = F.coalesce(lang_code("lang").cast("string"), F.lit(""))
    kind = F.pmod("doc_id", F.lit(10))
    line = (F.when(kind == 3, F.concat(F.lit("x"), code, F.lit(",")))
            .otherwise(F.concat(code, F.lit(","))))
    line = F.concat(line, F.lit('"'), F.col("doc_id").cast("string"), F.lit('"'),
                    F.when(kind == 5, F.lit("")).otherwise(F.concat(F.lit(","), quoted)),
                    F.when(kind == 7, F.lit(",more")).otherwise(F.lit("")))
    base = scratch_dir(spark, "checked")
    d.select(line.alias("value")).write.text(f"{base}/csv")
    return read_checked_csv(spark, f"{base}/csv", f"{base}/rows")


def q_csv_rejected(spark, sf_dir):
    """Good rows with their fields, rejected ones with their whole record; none is lost."""
    got = _checked_csv(spark, sf_dir)
    good = got.good.select(F.col("title").cast("long").alias("doc_id"), F.lit(True).alias("good"),
                           F.col("indexed_label").alias("code"), F.md5("description").alias("md5"))
    bad = got.rejected.select(
        F.regexp_extract("record", '^"?[^",]*"?,"([0-9]+)"', 1).cast("long").alias("doc_id"),
        F.lit(False).alias("good"), F.lit(None).cast("int").alias("code"), F.md5("record").alias("md5"))
    return good.unionByName(bad)


def q_csv_report(spark, sf_dir):
    return _checked_csv(spark, sf_dir).report()


def q_csv_job(spark, sf_dir):
    out = _csv_job(spark, sf_dir)
    rows = read_frame(spark, out["train"]).withColumn("split", F.lit("train")).unionByName(
        read_frame(spark, out["test"]).withColumn("split", F.lit("test")))
    return rows.select(F.col("title").cast("long").alias("doc_id"), "split", "label", "Y",
                       F.size("X").cast("long").alias("n_x"), ints_to_string("X").alias("X"))


def q_csv_job_vocab(spark, sf_dir):
    """Both vocabularies of the preprocessing job, read back."""
    out = _csv_job(spark, sf_dir)
    return read_vocab(spark, out["char_vocab"]).withColumn("vocab", F.lit("char")).unionByName(
        read_vocab(spark, out["label_vocab"]).withColumn("vocab", F.lit("label")))


def q_parquet_round_trip(spark, sf_dir):
    idx, vocab, _ = _char_prepared(spark, sf_dir, SMALL_CHAR_CAP)
    base = scratch_dir(spark, "parquet")
    write_frame(idx.select("row_id", "Y", "X"), f"{base}/frame")
    back = read_frame(spark, f"{base}/frame")
    return back.select(F.col("row_id").alias("doc_id"), "Y", ints_to_string("X").alias("X"))


def q_vocab_round_trip(spark, sf_dir):
    vocab = C.fit_character_vocab(_train(spark, sf_dir), CHAR_CAP)
    base = scratch_dir(spark, "vocab")
    return read_vocab(spark, write_vocab(vocab, f"{base}/char_vocab"))


def _model_frames(spark, sf_dir):
    a = _labelled(spark, sf_dir)
    train = a.where(F.col("split") == "train")
    test = a.where(F.col("split") == "test")
    label_vocab = C.fit_label_vocab(train, None)
    return train, test, label_vocab


def q_ngram_features(spark, sf_dir):
    """Distinct n-grams of each text, per n, as they enter the hashing."""
    a = _labelled(spark, sf_dir)
    t = T.with_tokens(a)
    feats = ngram_featurizer("T").fit(t).transform(t)
    grams = {n: "T" if n == 1 else f"_ngram{n}" for n in DEFAULT_NGRAMS}
    return feats.select(F.col("row_id").alias("doc_id"), *[
        F.size(F.array_distinct(c)).cast("long").alias(f"n{n}") for n, c in grams.items()])


def _probs_report(pred: DataFrame) -> DataFrame:
    """What SQL can state of a model's output: its classes in order, and that probabilities add up."""
    p = F.transform("probs", lambda c: c["p"])
    return pred.select(
        F.col("row_id").alias("doc_id"),
        F.array_join(F.transform("probs", lambda c: c["label"]), ",").alias("labels"),
        F.size("probs").cast("long").alias("n_classes"),
        F.round(F.aggregate(p, F.lit(0.0), lambda a, b: a + b), 6).alias("p_sum"),
    )


def q_predict_proba(spark, sf_dir):
    train, test, label_vocab = _model_frames(spark, sf_dir)
    _, pred = T.train_and_score(train, test, label_vocab)
    return _probs_report(pred)


def q_predict_texts(spark, sf_dir):
    """Raw texts to probabilities with the fitted model, null texts included."""
    train, test, label_vocab = _model_frames(spark, sf_dir)
    model, _ = T.train_and_score(train, test, label_vocab)
    raw = test.select("row_id", F.col("description").alias("text"))
    return _probs_report(predict_texts(model, raw, T.label_names_of(label_vocab)))


def q_predict_top(spark, sf_dir):
    """Per row whether the top class is the first of the most probable ones, by index and name."""
    train, test, label_vocab = _model_frames(spark, sf_dir)
    _, pred = T.train_and_score(train, test, label_vocab)
    p = F.transform("probs", lambda c: c["p"])
    at = F.array_position(p, F.array_max(p))
    return pred.select(
        F.col("row_id").alias("doc_id"), "Y",
        ((F.col("top.p") == F.array_max(p)) & (F.col("top.idx") == at - 1)
         & (F.col("prediction") == at - 1)
         & (F.col("top.label") == F.element_at("probs", at.cast("int"))["label"])).alias("is_argmax"))


def _accuracy_report(pred: DataFrame) -> DataFrame:
    """Row counts, and whether the accuracy is above the share of the commonest class."""
    return accuracy(pred, majority=True).select(
        "n", "n_unlabelled", (F.col("accuracy") > F.col("majority")).alias("beats_majority"))


def q_accuracy(spark, sf_dir):
    train, test, label_vocab = _model_frames(spark, sf_dir)
    _, pred = T.train_and_score(train, test, label_vocab)
    return _accuracy_report(pred)


def q_excluded_rows(spark, sf_dir):
    """Per split the rows that the classifier uses, and those it leaves out."""
    a = _labelled(spark, sf_dir)
    label_vocab = C.fit_label_vocab(a.where(F.col("split") == "train"), None)
    return T.row_report(a, label_vocab)


def q_char_accuracy(spark, sf_dir):
    """Character training job: classifier on the prepared character rows, scored on test."""
    idx, _, label_vocab = _char_prepared(spark, sf_dir, CHAR_CAP)
    split = F.col("split")
    _, pred = C.train_and_score_characters(idx.where(split == "train"),
                                           idx.where(split == "test"),
                                           T.label_names_of(label_vocab))
    return _accuracy_report(pred)


def _grams(spark, sf_dir):
    """Tokenized rows, their n-grams as dictionary numbers, the dictionary and the label vocabulary."""
    t = T.tokenized(_labelled(spark, sf_dir))
    train = t.where(F.col("split") == "train")
    label_vocab = C.fit_label_vocab(train, None)
    rows = gram_rows(t)
    dictionary = materialize(gram_dictionary(gram_rows(train), GRAM_MIN_DF))
    return index_labels(t, label_vocab, "label", "Y"), index_grams(rows, dictionary), dictionary, label_vocab


def q_ngram_dictionary(spark, sf_dir):
    return _grams(spark, sf_dir)[2]


def q_ngram_index(spark, sf_dir):
    """Every text's n-grams by dictionary number, per length; texts without a known one are left out."""
    indexed = gram_indices(_grams(spark, sf_dir)[1], ["row_id", "n"])
    return indexed.select(F.col("row_id").alias("doc_id"), "n", F.size("indices").alias("n_known"),
                          ints_to_string("indices").alias("indices"))


def q_predict_weights(spark, sf_dir):
    """All rows scored with given weights (from an md5 of class and n-gram) by join and aggregation."""
    rows, indexed, dictionary, label_vocab = _grams(spark, sf_dir)
    classes = F.array(*[F.lit(i) for i in range(label_vocab.count())])
    weights = dictionary.select(F.col("idx").alias("term"), "n", "gram", F.explode(classes).alias("cls"))
    weights = weights.select("term", "cls", (F.conv(F.substring(F.md5(F.concat_ws(
        "|", F.col("cls").cast("string"), F.col("n").cast("string"), "gram")), 1, 3), 16, 10).cast("double")
        / 1024 - 2).alias("w"))
    bias = label_vocab.select(F.col("idx").alias("cls"), (F.col("idx") * 0.25).cast("double").alias("w"))
    found = L.predict(rows, indexed.withColumnRenamed("idx", "term"), weights, bias)
    return found.select(F.col("row_id").alias("doc_id"), "prediction", F.explode("probs").alias("_p")).select(
        "doc_id", "prediction", "_p.cls", F.round("_p.p", 9).alias("p"))


def q_accuracy_steps(spark, sf_dir):
    """Rows and hits of both splits after each training step, from no weights on."""
    rows, indexed, _, label_vocab = _grams(spark, sf_dir)
    features = materialize(indexed.select("row_id", F.col("idx").alias("term")))
    return L.train_steps(materialize(rows.select("row_id", "split", "Y")), features, label_vocab.count(), STEPS,
                         scratch_dir(spark, "steps"), RATE, L2)


def _turns(spark, sf_dir):
    """Conversation turns as a second labelled text source (label = role).

    Row ids follow (conv_id, turn) and are assigned by the distributed dense
    index, as a reader would number rows in file order.
    """
    c = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    keys = c.select(F.col("conv_id").alias("_c"), F.col("turn").alias("_t"))
    numbered = dense_index(keys, [F.col("_c").asc(), F.col("_t").asc()], out="row_id")
    # The texts are joined to their numbers: only keys are range-sorted and frozen.
    same = F.col("conv_id").eqNullSafe(F.col("_c")) & F.col("turn").eqNullSafe(F.col("_t"))
    return c.join(numbered, same).drop("_c", "_t").withColumn("split", split_of("row_id"))


def q_conv_role_vocab(spark, sf_dir):
    t = _turns(spark, sf_dir).where(F.col("split") == "train")
    return build_label_vocab(t, "role", "row_id", CHAR_CAP)


def q_conv_token_vocab(spark, sf_dir):
    t = _turns(spark, sf_dir).where(F.col("split") == "train")
    return T.fit_token_vocab(t, text_col="text")


def q_token_decode(spark, sf_dir):
    """Index -> term through the token vocabulary; unseen indices decode to null."""
    idx, vocab = _token_indexed(spark, sf_dir)
    pairs = idx.select("row_id", F.posexplode("X").alias("pos", "idx"))
    named = term_of(vocab, "idx", pairs)
    out = named.groupBy("row_id").agg(
        F.array_sort(F.collect_list(F.struct("pos", F.coalesce("term", F.lit(UNSEEN_TERM))
                                             .alias("t")))).alias("p"))
    return out.select(
        F.col("row_id").alias("doc_id"),
        F.array_join(F.transform("p", lambda e: e["t"]), "|").alias("tokens"),
    )


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "char_vocab": q_char_vocab,
    "char_vocab_cap40": q_char_vocab_cap40,
    "token_vocab": q_token_vocab,
    "label_vocab": q_label_vocab,
    "vocab_size": q_vocab_size,
    "vocab_top10": q_vocab_top10,
    "label_names": q_label_names,
    "chars": q_chars,
    "tokens": q_tokens,
    "tokens_padded": q_tokens_padded,
    "char_index": q_char_index,
    "label_index": q_label_index,
    "label_index_many": q_label_index_many,
    "label_index_missing": q_label_index_missing,
    "token_index": q_token_index,
    "bucket_assign": q_bucket_assign,
    "bucket_counts": q_bucket_counts,
    "bucket_counts_test": q_bucket_counts_test,
    "bucket_counts_split": q_bucket_counts_split,
    "sliced_count": q_sliced_count,
    "batch_rows": q_batch_rows,
    "batch_order": q_batch_order,
    "batches": q_batches,
    "batches_test": q_batches_test,
    "first_batch": q_first_batch,
    "batches_epochs": q_batches_epochs,
    "batch_restart": q_batch_restart,
    "batch_at": q_batch_at,
    "left_out_rows": q_left_out_rows,
    "batch_layout": q_batch_layout,
    "batches_per_epoch": q_batches_per_epoch,
    "fixed_batches_train": q_fixed_batches_train,
    "fixed_batches_train_discard": q_fixed_batches_train_discard,
    "fixed_batches_test": q_fixed_batches_test,
    "first_rows": q_first_rows,
    "sample_exact": q_sample_exact,
    "random_row": q_random_row,
    "csv_round_trip": q_csv_round_trip,
    "csv_rejected": q_csv_rejected,
    "csv_report": q_csv_report,
    "csv_job": q_csv_job,
    "csv_job_vocab": q_csv_job_vocab,
    "parquet_round_trip": q_parquet_round_trip,
    "vocab_round_trip": q_vocab_round_trip,
    "ngram_features": q_ngram_features,
    "ngram_dictionary": q_ngram_dictionary,
    "ngram_index": q_ngram_index,
    "predict_weights": q_predict_weights,
    "accuracy_steps": q_accuracy_steps,
    "predict_proba": q_predict_proba,
    "predict_texts": q_predict_texts,
    "predict_top": q_predict_top,
    "accuracy": q_accuracy,
    "excluded_rows": q_excluded_rows,
    "char_accuracy": q_char_accuracy,
    "conv_role_vocab": q_conv_role_vocab,
    "conv_token_vocab": q_conv_token_vocab,
    "token_decode": q_token_decode,
}


# --------------------------------------------------------------------------
# DuckDB oracle side (written from the same definitions; the token rules
# and label names are the package's own constants, which tests/test_text.py checks by golden cases)
# --------------------------------------------------------------------------

def _sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


_LANG_CASE = "CASE lang " + " ".join(
    f"WHEN {_sql_str(k)} THEN {v}" for k, v in LANG_CODES.items()) + " END"
_LABEL_CASE = "CASE {c} " + " ".join(
    f"WHEN {k} THEN {_sql_str(v)}" for k, v in NEWS_LABELS.items()) + " END"
_SPLIT = (
    f"CASE WHEN substr(md5(concat_ws('|', 'split', '{SPLIT_SEED}', CAST(doc_id AS VARCHAR))), 1, 8)"
    f" < '{split_threshold()}' THEN 'test' ELSE 'train' END"
)

LABELLED = f"""
labelled AS (
  SELECT doc_id AS row_id, text AS description, {_SPLIT} AS split,
         {_LABEL_CASE.format(c=_LANG_CASE)} AS label
  FROM documents
)"""

_CHARS = "CASE WHEN length({t}) = 0 THEN []::VARCHAR[] ELSE string_split(lower({t}), '') END"


def _token_sql(t: str) -> str:
    expr = t
    for pattern, replacement in TOKEN_RULES:
        expr = f"regexp_replace({expr}, {_sql_str(pattern)}, {_sql_str(replacement)}, 'g')"
    return f"string_split(lower(trim({expr})), ' ')"


def _pad_sql(t: str) -> str:
    return (f"list_concat(({t})[1:{MAX_TOKENS}], list_transform(range(greatest({MAX_TOKENS} - "
            f"len({t}), 0)), lambda _x: {_sql_str(PAD_TOKEN)}))")


def _vocab_sql(seq_cte: str, cap: int | None) -> str:
    """Vocabulary over ``seq_cte(row_id, s)``: count desc, first (row, pos) asc."""
    limit = f"LIMIT {cap}" if cap is not None else ""
    return f"""
e AS (SELECT row_id, unnest(s) AS term, unnest(range(len(s))) AS pos FROM {seq_cte}),
g AS (SELECT term, count(*) AS n, min(row(row_id, pos)) AS first FROM e GROUP BY term),
top AS (SELECT * FROM g ORDER BY n DESC, first {limit}),
vocab AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, first) - 1 AS INTEGER) AS idx,
                 term, CAST(n AS BIGINT) AS n FROM top)"""


def _label_vocab_sql(cap: int | None, src: str = "labelled", col: str = "label") -> str:
    limit = f"LIMIT {cap}" if cap is not None else ""
    return f"""
lg AS (SELECT {col} AS term, count(*) AS n, min(row_id) AS first FROM {src}
       WHERE split = 'train' AND {col} IS NOT NULL GROUP BY {col}),
ltop AS (SELECT * FROM lg ORDER BY n DESC, first {limit}),
lvocab AS (SELECT CAST(row_number() OVER (ORDER BY n DESC, first) - 1 AS INTEGER) AS idx,
                  term, CAST(n AS BIGINT) AS n FROM ltop)"""


def _char_vocab_cte(cap: int) -> str:
    return f"""{LABELLED},
cs AS (SELECT row_id, {_CHARS.format(t='description')} AS s FROM labelled WHERE split = 'train'),
{_vocab_sql('cs', cap)}"""


def _token_vocab_cte() -> str:
    return f"""{LABELLED},
ts AS (SELECT row_id, {_pad_sql(_token_sql('description'))} AS s FROM labelled
       WHERE split = 'train'),
{_vocab_sql('ts', None)}"""


def _int_list(x: str) -> str:
    return f"array_to_string(list_transform({x}, lambda _v: CAST(_v AS VARCHAR)), ',')"


def _char_index_cte(cap: int) -> str:
    return f"""{_char_vocab_cte(cap)},
{_label_vocab_sql(CHAR_CAP)},
vl AS (SELECT list(term ORDER BY idx) AS V FROM vocab),
ll AS (SELECT list(term ORDER BY idx) AS L FROM lvocab),
indexed AS (
  SELECT row_id, split, label,
         CAST(coalesce(list_position(L, label), 0) - 1 AS INTEGER) AS Y,
         list_transform({_CHARS.format(t='description')},
                        lambda c: CAST(coalesce(list_position(V, c), 0) - 1 AS INTEGER)) AS X
  FROM labelled, vl, ll
)"""


_BUCKET_CASE = (
    "CASE " + " ".join(f"WHEN len(X) <= {b} THEN {b}" for b in DEFAULT_BUCKETS[:-1])
    + f" ELSE {DEFAULT_BUCKETS[-1]} END"
)


def _bucketed_cte(split: str | None = "train") -> str:
    where = f"WHERE split = '{split}'" if split else ""
    top = DEFAULT_BUCKETS[-1]
    return f"""{_char_index_cte(SMALL_CHAR_CAP)},
bk AS (SELECT row_id, split, Y, X, CAST(len(X) AS INTEGER) AS length,
              CAST({_BUCKET_CASE} AS INTEGER) AS bucket, len(X) > {top} AS sliced
       FROM indexed {where}),
bucketed AS (SELECT *, list_concat(X[1:bucket], list_transform(range(greatest(bucket - length, 0)),
                    lambda _x: -1)) AS P FROM bk)"""


def _batch_rows_cte(split: str = "train") -> str:
    return f"""{_bucketed_cte(split)},
keyed AS (SELECT row_id, bucket, P, Y,
                 md5(concat_ws('|', '{SEED}', '{EPOCH}', CAST(row_id AS VARCHAR))) AS k FROM bucketed),
ranked AS (SELECT *, row_number() OVER (PARTITION BY bucket ORDER BY k, row_id) - 1 AS rnk,
                  count(*) OVER (PARTITION BY bucket) AS bn FROM keyed),
brows AS (SELECT CAST({EPOCH} AS INTEGER) AS epoch, bucket, CAST(rnk // {BATCH} AS BIGINT) AS batch,
                 row_id, CAST(rnk AS BIGINT) AS rank, P, Y
          FROM ranked WHERE rnk // {BATCH} < bn // {BATCH}),
border AS (SELECT epoch, bucket, batch,
                  CAST(row_number() OVER (ORDER BY md5(concat_ws('|', '{SEED}', CAST(epoch AS VARCHAR),
                       CAST(bucket AS VARCHAR), CAST(batch AS VARCHAR))), bucket, batch) - 1 AS BIGINT)
                  AS batch_seq
           FROM (SELECT DISTINCT epoch, bucket, batch FROM brows))"""


_BATCH_REPORT = f"""
bt AS (
  SELECT r.epoch, o.batch_seq, r.bucket, CAST(count(*) AS BIGINT) AS n_rows,
         CAST(r.bucket AS INTEGER) AS seq_len,
         string_agg(CAST(r.row_id AS VARCHAR), ',' ORDER BY r.rank) AS row_ids,
         string_agg(CAST(r.Y AS VARCHAR), ',' ORDER BY r.rank) AS Y,
         md5(string_agg({_int_list('r.P')}, ';' ORDER BY r.rank)) AS X_md5
  FROM brows r JOIN border o USING (epoch, bucket, batch)
  GROUP BY r.epoch, o.batch_seq, r.bucket, r.batch
)"""


def _fixed_sql(split: str, shuffle: bool, pad: bool) -> str:
    order = (f"md5(concat_ws('|', '{SEED}', '{EPOCH}', CAST(row_id AS VARCHAR))), row_id"
             if shuffle else "row_id")
    bs = TOKEN_BATCH
    base = f"""WITH {LABELLED},
r AS (SELECT row_id, row_number() OVER (ORDER BY {order}) - 1 AS rnk, count(*) OVER () AS total
      FROM labelled WHERE split = '{split}'),
main AS (SELECT rnk // {bs} AS batch, rnk % {bs} AS slot, row_id,
                CASE WHEN rnk // {bs} = total // {bs} THEN {bs} - total % {bs} ELSE 0 END AS pad,
                total FROM r)"""
    if not pad:
        body = "SELECT batch, slot, row_id, 0 AS pad FROM main WHERE batch < total // %d" % bs
    else:  # every place of every batch holds a row; the order starts again at its end
        body = f"""SELECT p // {bs} AS batch, p % {bs} AS slot, r.row_id,
       CASE WHEN p // {bs} = r.total // {bs} THEN {bs} - r.total % {bs} ELSE 0 END AS pad
FROM (SELECT unnest(range(CAST(ceil(count(*) / {bs}) * {bs} AS BIGINT))) AS p FROM r) places
JOIN r ON r.rnk = p % r.total"""
    return f"""{base}
SELECT CAST({EPOCH} AS INTEGER) AS epoch, CAST(batch AS BIGINT) AS batch, CAST(slot AS INTEGER) AS slot,
       row_id AS doc_id, CAST(pad AS INTEGER) AS pad
FROM ({body}) x"""


_TURNS = f"""turns AS (
  SELECT conv_id, turn, role, text,
         row_number() OVER (ORDER BY conv_id, turn) - 1 AS row_id,
         {_SPLIT.replace('doc_id', '(row_number() OVER (ORDER BY conv_id, turn) - 1)')} AS split
  FROM conversations)"""


def _key_sql(col: str) -> str:
    return f"md5(concat_ws('|', '{SEED}', CAST({col} AS VARCHAR)))"


def _both_splits_sql(of: Callable[[str], str]) -> str:
    return " UNION ALL ".join(f"SELECT '{s}' AS split, * FROM ({of(s)})" for s in ("train", "test"))


def _epochs_cte(split: str = "train") -> str:
    """Ranks and batch orders of all ``EPOCHS`` at once (names as in ``_batch_rows_cte``)."""
    return f"""{_bucketed_cte(split)},
keyed AS (SELECT row_id, bucket, P, Y, epoch,
                 md5(concat_ws('|', '{SEED}', CAST(epoch AS VARCHAR), CAST(row_id AS VARCHAR))) AS k
          FROM bucketed, (SELECT unnest({EPOCHS}) AS epoch)),
ranked AS (SELECT *, row_number() OVER (PARTITION BY epoch, bucket ORDER BY k, row_id) - 1 AS rnk,
                  count(*) OVER (PARTITION BY epoch, bucket) AS bn FROM keyed),
brows AS (SELECT CAST(epoch AS INTEGER) AS epoch, bucket, CAST(rnk // {BATCH} AS BIGINT) AS batch, row_id,
                 CAST(rnk AS BIGINT) AS rank, P, Y FROM ranked WHERE rnk // {BATCH} < bn // {BATCH}),
border AS (SELECT epoch, bucket, batch,
                  CAST(row_number() OVER (PARTITION BY epoch ORDER BY md5(concat_ws('|', '{SEED}',
                       CAST(epoch AS VARCHAR), CAST(bucket AS VARCHAR), CAST(batch AS VARCHAR))), bucket, batch)
                  - 1 AS BIGINT) AS batch_seq
           FROM (SELECT DISTINCT epoch, bucket, batch FROM brows))"""


def _grams_cte() -> str:
    """n-grams of every row (``gr``), the dictionary of the train rows (``dict``), known ones (``ft``)."""
    each = " UNION ALL ".join(
        f"SELECT row_id, split, {n} AS n, unnest(list_distinct(list_transform("
        f"range(greatest(len(s) - {n - 1}, 0)), lambda i: array_to_string(s[i + 1:i + {n}], ' ')))) AS gram FROM tk"
        for n in DEFAULT_NGRAMS)
    return f"""{LABELLED}, {_label_vocab_sql(None)},
tk AS MATERIALIZED (SELECT row_id, split, {_pad_sql(_token_sql('description'))} AS s FROM labelled),
gr AS MATERIALIZED ({each}),
dict AS MATERIALIZED (
  SELECT row_number() OVER (ORDER BY n, df DESC, gram) - 1 AS idx, n, gram, df
  FROM (SELECT n, gram, count(*) AS df FROM gr WHERE split = 'train'
        GROUP BY n, gram HAVING count(*) >= {GRAM_MIN_DF})),
ft AS MATERIALIZED (SELECT row_id, n, idx FROM gr JOIN dict USING (n, gram))"""


def _softmax_sql(name: str, rows: str, weights: str, bias: str) -> str:
    """Probabilities ``{name}_p`` (row_id, cls, p) and top classes ``{name}_top`` of ``rows``."""
    return f"""
{name}_s AS (SELECT row_id, cls, sum(w) AS s FROM (
  SELECT ft.row_id, w.cls, w.w FROM ft JOIN {weights} w ON ft.idx = w.term SEMI JOIN {rows} r ON ft.row_id = r.row_id
  UNION ALL SELECT row_id, cls, w FROM {rows}, {bias}) GROUP BY row_id, cls),
{name}_e AS (SELECT row_id, cls, exp(s - max(s) OVER (PARTITION BY row_id)) AS e FROM {name}_s),
{name}_p AS MATERIALIZED (SELECT row_id, cls, e / sum(e) OVER (PARTITION BY row_id) AS p FROM {name}_e),
{name}_top AS (SELECT row_id, cls AS prediction FROM {name}_p
  QUALIFY row_number() OVER (PARTITION BY row_id ORDER BY round(p, 9) DESC, cls) = 1)"""


def _steps_sql() -> str:
    """Gradient descent written out step by step."""
    ctes = [_grams_cte(), """kn AS MATERIALIZED (SELECT row_id, split, v.idx AS Y FROM labelled JOIN lvocab v ON label = v.term),
w0 AS (SELECT CAST(0 AS BIGINT) AS term, 0 AS cls, CAST(0 AS DOUBLE) AS w WHERE FALSE),
b0 AS (SELECT idx AS cls, CAST(0 AS DOUBLE) AS w FROM lvocab)"""]
    parts = []
    for k in range(STEPS + 1):
        ctes.append(_softmax_sql(f"m{k}", "kn", f"w{k}", f"b{k}"))
        parts.append(f"SELECT {k} AS step, split, count(*) AS n, count(*) FILTER (prediction = Y) AS n_correct "
                     f"FROM kn JOIN m{k}_top USING (row_id) GROUP BY split")
        ctes.append(f"""r{k} AS MATERIALIZED (
  SELECT row_id, cls, p - CASE WHEN cls = Y THEN 1 ELSE 0 END AS r FROM m{k}_p JOIN kn USING (row_id)
  WHERE split = 'train'),
g{k} AS (SELECT idx AS term, cls, sum(r) / (SELECT count(*) FROM kn WHERE split = 'train') AS g
  FROM r{k} JOIN ft USING (row_id) GROUP BY idx, cls),
w{k + 1} AS MATERIALIZED (SELECT term, cls, coalesce(w, 0) * (1 - {RATE} * {L2}) - {RATE} * coalesce(g, 0) AS w
  FROM g{k} FULL JOIN w{k} USING (term, cls)),
b{k + 1} AS MATERIALIZED (SELECT b.cls, b.w - {RATE} * coalesce(g, 0) AS w FROM b{k} b LEFT JOIN (
  SELECT cls, sum(r) / (SELECT count(*) FROM kn WHERE split = 'train') AS g FROM r{k} GROUP BY cls) x USING (cls))""")
    return "WITH " + ",\n".join(ctes) + "\n" + " UNION ALL ".join(parts)


# A model's values are its own; SQL states what must hold of them.
_PROBS_SQL = f"""WITH {LABELLED}, {_label_vocab_sql(None)}
SELECT row_id AS doc_id, (SELECT string_agg(term, ',' ORDER BY idx) FROM lvocab) AS labels,
       (SELECT count(*) FROM lvocab) AS n_classes, CAST(1 AS DOUBLE) AS p_sum
FROM labelled WHERE split = 'test'"""
_ACCURACY_SQL = f"""WITH {LABELLED}, {_label_vocab_sql(None)}
SELECT count(v.idx) AS n, count(*) - count(v.idx) AS n_unlabelled, TRUE AS beats_majority
FROM labelled LEFT JOIN lvocab v ON label = v.term WHERE split = 'test'"""


ORACLE_SQL: dict[str, str] = {
    "char_vocab": f"WITH {_char_vocab_cte(CHAR_CAP)} SELECT idx, term, n FROM vocab",
    "char_vocab_cap40": f"WITH {_char_vocab_cte(SMALL_CHAR_CAP)} SELECT idx, term, n FROM vocab",
    "token_vocab": f"WITH {_token_vocab_cte()} SELECT idx, term, n FROM vocab",
    "label_vocab": f"WITH {LABELLED}, {_label_vocab_sql(CHAR_CAP)} SELECT idx, term, n FROM lvocab",
    "vocab_size": f"""WITH {_token_vocab_cte()},
c_cs AS (SELECT row_id, {_CHARS.format(t='description')} AS s FROM labelled WHERE split = 'train'),
c_e AS (SELECT unnest(s) AS term FROM c_cs),
{_label_vocab_sql(None)}
SELECT 'char' AS vocab, CAST(least((SELECT count(DISTINCT term) FROM c_e), {CHAR_CAP}) AS BIGINT) AS terms
UNION ALL SELECT 'token', (SELECT count(*) FROM vocab)
UNION ALL SELECT 'label', (SELECT count(*) FROM lvocab)""",
    "vocab_top10": f"WITH {_token_vocab_cte()} SELECT idx, term, n FROM vocab WHERE idx < 10",
    "label_names": f"WITH {LABELLED} SELECT row_id AS doc_id, label FROM labelled",
    "chars": f"""SELECT doc_id, CAST(len({_CHARS.format(t='text')}) AS BIGINT) AS n_chars,
       md5(array_to_string({_CHARS.format(t='text')}, chr(1))) AS chars_md5 FROM documents""",
    "tokens": f"""SELECT doc_id, CAST(len({_token_sql('text')}) AS BIGINT) AS n_tokens,
       array_to_string({_token_sql('text')}, '|') AS tokens FROM documents""",
    "tokens_padded": f"""SELECT doc_id, CAST(len({_pad_sql(_token_sql('text'))}) AS BIGINT) AS n_tokens,
       array_to_string({_pad_sql(_token_sql('text'))}, '|') AS tokens FROM documents""",
    "char_index": f"""WITH {_char_index_cte(SMALL_CHAR_CAP)}
SELECT row_id AS doc_id, split, label, Y, CAST(len(X) AS BIGINT) AS n_x, {_int_list('X')} AS X
FROM indexed""",
    "label_index": f"""WITH {_char_index_cte(CHAR_CAP)}
SELECT row_id AS doc_id, split, label, Y FROM indexed""",
    "label_index_many": f"""WITH lm AS (
  SELECT doc_id AS row_id, {_SPLIT} AS split, substr(text, 1, {LABEL_CHARS}) AS label FROM documents),
{_label_vocab_sql(None, 'lm')}
SELECT lm.row_id AS doc_id, lm.split, lm.label, CAST(coalesce(v.idx, -1) AS INTEGER) AS Y
FROM lm LEFT JOIN lvocab v ON lm.label = v.term""",
    "label_index_missing": f"""WITH lm AS (
  SELECT d.doc_id AS row_id, {_SPLIT.replace('doc_id', 'd.doc_id')} AS split,
         {_LABEL_CASE.format(c='(l.quality + 1)')} AS label
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id),
{_label_vocab_sql(CHAR_CAP, 'lm')},
ll AS (SELECT list(term ORDER BY idx) AS L FROM lvocab)
SELECT row_id AS doc_id, split, label,
       CAST(coalesce(list_position(L, label), 0) - 1 AS INTEGER) AS Y
FROM lm, ll""",
    "token_index": f"""WITH {_token_vocab_cte()},
{_label_vocab_sql(None)},
ll AS (SELECT list(term ORDER BY idx) AS L FROM lvocab),
ta AS (SELECT row_id, split, label, {_pad_sql(_token_sql('description'))} AS s FROM labelled),
te AS (SELECT row_id, unnest(s) AS term, unnest(range(len(s))) AS pos FROM ta),
tj AS (SELECT te.row_id, te.pos, coalesce(v.idx, -1) AS i FROM te LEFT JOIN vocab v ON te.term = v.term),
tx AS (SELECT row_id, string_agg(CAST(i AS VARCHAR), ',' ORDER BY pos) AS X FROM tj GROUP BY row_id)
SELECT ta.row_id AS doc_id, ta.split, ta.label,
       CAST(coalesce(list_position(L, ta.label), 0) - 1 AS INTEGER) AS Y, tx.X
FROM ta JOIN tx USING (row_id), ll""",
    "bucket_assign": f"""WITH {_bucketed_cte(None)}
SELECT row_id AS doc_id, length, bucket, sliced, md5({_int_list('P')}) AS P_md5 FROM bucketed""",
    "bucket_counts": f"""WITH {_bucketed_cte()},
sizes AS (SELECT CAST(unnest({list(DEFAULT_BUCKETS)}) AS INTEGER) AS bucket)
SELECT s.bucket, CAST(count(b.row_id) AS BIGINT) AS n
FROM sizes s LEFT JOIN bucketed b ON s.bucket = b.bucket GROUP BY s.bucket""",
    "bucket_counts_test": f"""WITH {_bucketed_cte('test')},
sizes AS (SELECT CAST(unnest({list(DEFAULT_BUCKETS)}) AS INTEGER) AS bucket)
SELECT s.bucket, CAST(count(b.row_id) AS BIGINT) AS n
FROM sizes s LEFT JOIN bucketed b ON s.bucket = b.bucket GROUP BY s.bucket""",
    "bucket_counts_split": _both_splits_sql(lambda split: f"""WITH {_bucketed_cte(split)},
sizes AS (SELECT CAST(unnest({list(DEFAULT_BUCKETS)}) AS INTEGER) AS bucket)
SELECT s.bucket, CAST(count(b.row_id) AS BIGINT) AS n
FROM sizes s LEFT JOIN bucketed b ON s.bucket = b.bucket GROUP BY s.bucket"""),
    "sliced_count": _both_splits_sql(lambda split: f"""WITH {_bucketed_cte(split)}
SELECT CAST(coalesce(sum(CAST(sliced AS BIGINT)), 0) AS BIGINT) AS n_sliced FROM bucketed"""),
    "batch_rows": _both_splits_sql(lambda split: f"""WITH {_batch_rows_cte(split)}
SELECT epoch, bucket, batch, row_id AS doc_id, rank FROM brows"""),
    "batch_order": _both_splits_sql(
        lambda split: f"WITH {_batch_rows_cte(split)} SELECT epoch, bucket, batch, batch_seq FROM border"),
    "batches": f"""WITH {_batch_rows_cte()}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt""",
    "batches_test": f"""WITH {_batch_rows_cte('test')}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt""",
    "batches_epochs": f"""WITH {_epochs_cte()}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt""",
    "batch_restart": f"""WITH {_epochs_cte()}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt
WHERE epoch = {EPOCHS[1]} AND batch_seq >= {RESTART}""",
    "batch_at": f"""WITH {_epochs_cte()}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt
WHERE epoch = {EPOCHS[2]} AND batch_seq = {RESTART}""",
    "left_out_rows": f"""WITH {_epochs_cte()}
SELECT CAST(epoch AS INTEGER) AS epoch, bucket, row_id AS doc_id, CAST(rnk AS BIGINT) AS rank
FROM ranked WHERE rnk // {BATCH} >= bn // {BATCH}""",
    "first_batch": _both_splits_sql(lambda split: f"""WITH {_batch_rows_cte(split)}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, n_rows, seq_len, row_ids, Y, X_md5 FROM bt WHERE batch_seq = 0"""),
    "batch_layout": _both_splits_sql(lambda split: f"""WITH {_batch_rows_cte(split)}, {_BATCH_REPORT}
SELECT epoch, batch_seq, bucket, CAST(n_rows AS VARCHAR) || ',' || CAST(seq_len AS VARCHAR) AS data_shape,
       CAST(n_rows AS VARCHAR) AS label_shape, CAST({max(DEFAULT_BUCKETS)} AS INTEGER) AS default_bucket_key
FROM bt"""),
    "batches_per_epoch": _both_splits_sql(lambda split: f"""WITH {_bucketed_cte(split)},
pb AS (SELECT bucket, count(*) AS n FROM bucketed GROUP BY bucket)
SELECT CAST(coalesce(sum(n), 0) // {BATCH} AS BIGINT) AS naive,
       CAST(coalesce(sum(n // {BATCH}), 0) AS BIGINT) AS actual FROM pb"""),
    "fixed_batches_train": _fixed_sql("train", True, True),
    "fixed_batches_train_discard": _fixed_sql("train", True, False),
    "fixed_batches_test": _fixed_sql("test", False, True),
    "first_rows": f"""WITH {LABELLED}
SELECT row_id AS doc_id, label, split FROM labelled ORDER BY row_id LIMIT 5""",
    "sample_exact": f"""WITH {LABELLED},
c AS (SELECT CAST(round_even({SAMPLE_FRACTION} * count(*), 0) AS BIGINT) AS n FROM labelled),
k AS (SELECT row_id, label, split, row_number() OVER (ORDER BY {_key_sql('row_id')}) AS rn
      FROM labelled)
SELECT row_id AS doc_id, label, split FROM k, c WHERE rn <= c.n""",
    "random_row": f"""WITH {LABELLED}
SELECT row_id AS doc_id, label, description AS text FROM labelled WHERE split = 'test'
ORDER BY {_key_sql('row_id')}, row_id LIMIT 1""",
    "csv_round_trip": "SELECT doc_id, text, lang FROM documents",
    "csv_rejected": f"""WITH c AS (
  SELECT doc_id, text, doc_id % 10 AS kind, {_LANG_CASE} AS code,
         '"' || replace(text, '"', '""') || '"' AS quoted FROM documents)
SELECT doc_id, kind NOT IN (3, 5, 7) AS good, CASE WHEN kind NOT IN (3, 5, 7) THEN code END AS code,
       CASE kind WHEN 3 THEN md5('"x' || code || '","' || doc_id || '",' || quoted)
                 WHEN 5 THEN md5(code || ',"' || doc_id || '"')
                 WHEN 7 THEN md5(code || ',"' || doc_id || '",' || quoted || ',more')
                 ELSE md5(text) END AS md5 FROM c""",
    "csv_report": """SELECT count(*) AS n_rows, count(*) FILTER (doc_id % 10 NOT IN (3, 5, 7)) AS n_good,
       count(*) FILTER (doc_id % 10 IN (3, 5, 7)) AS n_rejected, 0 AS null_indexed_label, 0 AS null_title,
       0 AS null_description FROM documents""",
    "csv_job": f"""WITH {_char_index_cte(SMALL_CHAR_CAP)}
SELECT row_id AS doc_id, split, label, Y, CAST(len(X) AS BIGINT) AS n_x, {_int_list('X')} AS X
FROM indexed""",
    "csv_job_vocab": f"""WITH {_char_index_cte(SMALL_CHAR_CAP)}
SELECT idx, term, n, 'char' AS vocab FROM vocab
UNION ALL SELECT idx, term, n, 'label' FROM lvocab""",
    "parquet_round_trip": f"""WITH {_char_index_cte(SMALL_CHAR_CAP)}
SELECT row_id AS doc_id, Y, {_int_list('X')} AS X FROM indexed""",
    "vocab_round_trip": f"WITH {_char_vocab_cte(CHAR_CAP)} SELECT idx, term, n FROM vocab",
    "conv_role_vocab": f"""WITH {_TURNS},
{_label_vocab_sql(CHAR_CAP, 'turns', 'role')}
SELECT idx, term, n FROM lvocab""",
    "conv_token_vocab": f"""WITH {_TURNS},
ts AS (SELECT row_id, {_pad_sql(_token_sql('text'))} AS s FROM turns WHERE split = 'train'),
{_vocab_sql('ts', None)}
SELECT idx, term, n FROM vocab""",
    "token_decode": f"""WITH {_token_vocab_cte()},
ta AS (SELECT row_id, {_pad_sql(_token_sql('description'))} AS s FROM labelled),
te AS (SELECT row_id, unnest(s) AS term, unnest(range(len(s))) AS pos FROM ta),
tj AS (SELECT te.row_id, te.pos, coalesce(v.term, '{UNSEEN_TERM}') AS t
       FROM te LEFT JOIN vocab v ON te.term = v.term)
SELECT row_id AS doc_id, string_agg(t, '|' ORDER BY pos) AS tokens FROM tj GROUP BY row_id""",
    "ngram_features": f"""WITH tk AS (SELECT doc_id, {_pad_sql(_token_sql('text'))} AS s FROM documents)
SELECT doc_id, """ + ", ".join(
        f"CAST(len(list_distinct(list_transform(range(greatest(len(s) - {n - 1}, 0)), lambda i: "
        f"array_to_string(s[i + 1:i + {n}], ' ')))) AS BIGINT) AS n{n}" for n in DEFAULT_NGRAMS)
    + " FROM tk",
    "ngram_dictionary": f"WITH {_grams_cte()} SELECT idx, n, gram, df FROM dict",
    "ngram_index": f"""WITH {_grams_cte()}
SELECT row_id AS doc_id, n, count(*) AS n_known, string_agg(CAST(idx AS VARCHAR), ',' ORDER BY idx) AS indices
FROM ft GROUP BY row_id, n""",
    "predict_weights": f"""WITH {_grams_cte()},
wt AS (SELECT d.idx AS term, v.idx AS cls, CAST(('0x' || substr(md5(concat_ws('|', CAST(v.idx AS VARCHAR),
         CAST(d.n AS VARCHAR), d.gram)), 1, 3)) AS INTEGER) / 1024.0::DOUBLE - 2 AS w FROM dict d, lvocab v),
bs AS (SELECT idx AS cls, idx * 0.25::DOUBLE AS w FROM lvocab),
{_softmax_sql('m', 'labelled', 'wt', 'bs')}
SELECT row_id AS doc_id, prediction, cls, round(p, 9) AS p FROM m_p JOIN m_top USING (row_id)""",
    "accuracy_steps": _steps_sql(),
    "predict_proba": _PROBS_SQL,
    "predict_texts": _PROBS_SQL,
    "predict_top": f"""WITH {LABELLED}, {_label_vocab_sql(None)}
SELECT row_id AS doc_id, CAST(coalesce(v.idx, -1) AS INTEGER) AS Y, TRUE AS is_argmax
FROM labelled LEFT JOIN lvocab v ON label = v.term WHERE split = 'test'""",
    "accuracy": _ACCURACY_SQL,
    "excluded_rows": f"""WITH {LABELLED}, {_label_vocab_sql(None)}
SELECT split, count(*) AS n, count(*) FILTER (WHERE description IS NULL) AS n_null_text,
       count(*) - count(v.idx) AS n_no_class, count(v.idx) AS n_used
FROM labelled LEFT JOIN lvocab v ON label = v.term GROUP BY split""",
    "char_accuracy": _ACCURACY_SQL,
}
