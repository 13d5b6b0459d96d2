"""Token path: regex tokens -> fixed length -> uncapped vocabulary -> X, Y -> classifier."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.functions.text import MAX_TOKENS, PAD_TOKEN, pad_tokens, tokens
from seqframe.operators.index import index_labels, index_sequences
from seqframe.operators.model import fit_classifier
from seqframe.operators.predict import predict_proba
from seqframe.operators.vocab import build_vocab
from seqframe.plans.character import fit_label_vocab
from seqframe.session import materialize


@dataclass
class TokenPrepared:
    train: DataFrame
    test: DataFrame
    vocab: DataFrame
    label_vocab: DataFrame


def with_tokens(df: DataFrame, text_col: str = "description", max_tokens: int = MAX_TOKENS,
                pad: str = PAD_TOKEN, out: str = "T") -> DataFrame:
    return df.withColumn(out, pad_tokens(tokens(text_col), max_tokens, pad))


def tokenized(df: DataFrame, text_col: str = "description", max_tokens: int = MAX_TOKENS,
              out: str = "T") -> DataFrame:
    """``df`` with padded tokens ``out`` in place of the text, written once.

    The 13 rules run over every whole text, the costliest per-row step of the
    token path.  Fitting and indexing both read the frame, so it is
    checkpointed: the rules run once per row, and later jobs read short token
    arrays instead of the text.
    """
    return materialize(with_tokens(df, text_col, max_tokens, out=out).drop(text_col))


def fit_vocab_from_tokens(t: DataFrame, row_col: str = "row_id", cap: int | None = None,
                          tokens_col: str = "T") -> DataFrame:
    """Vocabulary of already tokenized (padded) rows."""
    return build_vocab(t.select(row_col, tokens_col), tokens_col, row_col, cap)


def fit_token_vocab(train: DataFrame, text_col: str = "description", row_col: str = "row_id",
                    max_tokens: int = MAX_TOKENS, cap: int | None = None) -> DataFrame:
    """Counted over padded sequences, so the pad token is an entry too."""
    t = with_tokens(train.select(row_col, text_col), text_col, max_tokens)
    return fit_vocab_from_tokens(t, row_col, cap)


def index_token_frame(t: DataFrame, vocab: DataFrame, label_vocab: DataFrame,
                      label_col: str = "label", row_col: str = "row_id",
                      carry: tuple[str, ...] = (), tokens_col: str = "T") -> DataFrame:
    """``(row_id, label, Y, *carry, X)`` from already tokenized rows."""
    t = index_labels(t, label_vocab, label_col, "Y")
    keep = [label_col, "Y", *carry]
    return index_sequences(t.select(row_col, tokens_col, *keep), tokens_col, vocab, out="X",
                           row_col=row_col, carry=keep, method="auto")


def index_tokens(df: DataFrame, vocab: DataFrame, label_vocab: DataFrame,
                 text_col: str = "description", label_col: str = "label",
                 row_col: str = "row_id", max_tokens: int = MAX_TOKENS,
                 carry: tuple[str, ...] = ()) -> DataFrame:
    """``(row_id, label, Y, *carry, X)``; the text itself is not carried."""
    return index_token_frame(with_tokens(df, text_col, max_tokens), vocab, label_vocab,
                             label_col, row_col, carry)


def prepare_tokens(train: DataFrame, test: DataFrame, text_col: str = "description",
                   label_col: str = "label", row_col: str = "row_id",
                   max_tokens: int = MAX_TOKENS) -> TokenPrepared:
    """Fit on ``train``, index both; each text is tokenized once."""
    tr = tokenized(train, text_col, max_tokens)
    vocab = fit_vocab_from_tokens(tr, row_col)
    label_vocab = fit_label_vocab(tr, None, label_col, row_col)
    return TokenPrepared(
        index_token_frame(tr, vocab, label_vocab, label_col, row_col),
        index_tokens(test, vocab, label_vocab, text_col, label_col, row_col, max_tokens),
        vocab,
        label_vocab,
    )


def label_names_of(label_vocab: DataFrame) -> list[str]:
    """Every class name in index order; a model has coefficients for each of them anyway."""
    rows = label_vocab.select("idx", "term").collect()
    return [r["term"] for r in sorted(rows, key=lambda r: r["idx"])]


def row_report(df: DataFrame, label_vocab: DataFrame, text_col: str = "description",
               label_col: str = "label", by: str = "split") -> DataFrame:
    """``(by, n, n_null_text, n_no_class, n_used)``: what ``train_and_score`` makes of the rows.

    Rows whose label is null or unknown in training are not learned from and not counted in the
    accuracy; rows of null text are used, without n-grams.
    """
    y = index_labels(df.select(by, label_col, F.col(text_col).isNull().alias("_null")), label_vocab,
                     label_col, "Y")
    known = F.col("Y") >= 0
    return y.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.count_if("_null").alias("n_null_text"),
        F.count_if(~known).alias("n_no_class"), F.count_if(known).alias("n_used"))


def train_and_score(train: DataFrame, test: DataFrame, label_vocab: DataFrame,
                    text_col: str = "description", label_col: str = "label",
                    row_col: str = "row_id", max_tokens: int = MAX_TOKENS,
                    **fit_args) -> tuple[PipelineModel, DataFrame]:
    """Fit the n-gram classifier on train; probabilities and top class for test."""
    names = label_names_of(label_vocab)
    # A null text has no tokens, hence no n-grams; it is scored by the class priors.
    no_null = F.coalesce("T", F.array().cast("array<string>"))
    # The fit reads its rows once per iteration and the rules cost most: tokens are written once.
    tr, te = (index_labels(tokenized(df.select(row_col, text_col, label_col), text_col, max_tokens).withColumn(
        "T", no_null), label_vocab, label_col, "Y") for df in (train, test))
    model = fit_classifier(tr.select(row_col, "T", "Y"), "T", "Y", **fit_args)
    return model, predict_proba(model, te.select(row_col, "T", "Y"), names, row_col, keep=["Y"])
