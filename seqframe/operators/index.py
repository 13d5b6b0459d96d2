"""Sequence and label indexing with a fitted vocabulary; unseen -> -1.

Two physical strategies, picked by the vocabulary's (checked) size:

* array path (small vocabularies: characters, labels): the terms become an
  array literal and each element is looked up with ``array_position``.  A pure
  projection: no shuffle, works on streaming frames.
* join path (large vocabularies: tokens, many labels): for sequences
  ``posexplode_outer`` -> look up -> regroup by row in position order, which
  needs unique row ids.  The vocabulary is broadcast when its counted terms and
  bytes allow.  Past those bounds its most frequent terms of bounded length are
  broadcast, then the answers for the most frequent terms still open (unseen
  or long ones, by the SHA-256 of the term).  A broadcast Bloom filter of the
  other entries answers nearly all unseen terms among the rest without a
  shuffle; what may be known goes through a shuffle join, where no term holds
  more than one part in ``hot_terms``.

Both give the same result.  A null element is no term: it is not counted by
``vocab.term_counts`` and its index is ``unseen``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.functions.text import UNSEEN
from seqframe.operators.vocab import (
    BROADCAST_MAX_BYTES,
    BROADCAST_MAX_TERMS,
    HOT_TERMS,
    fits_broadcast,
    hot_entry,
    small_terms,
)
from seqframe.session import materialize

# Largest vocabulary looked up by array scan (per element cost is linear).
ARRAY_MAX_TERMS = 256
# Code points below this are indexed by their place in an array of indices, others by a scan.
DENSE_CODES = 0x250

# Bloom filter of the entries that are not broadcast: 64-bit words of about 6 terms with 5 bits each
# (about 1 % of unseen terms pass); 4M words of two numbers are a broadcast of some 100 MB.
BLOOM_BITS = 5
BLOOM_TERMS_PER_WORD = 6
BLOOM_MAX_WORDS = 4_000_000


def _terms_array(terms: Sequence[str]) -> Column:
    return F.array(*[F.lit(t) for t in terms]).cast("array<string>")


def index_with_terms(seq: Column | str, terms: Sequence[str], unseen: int = UNSEEN) -> Column:
    """Index each element by its position in ``terms``; unseen -> ``unseen``."""
    s = F.col(seq) if isinstance(seq, str) else seq
    arr = _terms_array(terms)
    # array_position is 1-based and 0 when missing, so "- 1" maps a miss to -1.
    # It is null for a null element.
    found = F.transform(
        s, lambda x: F.coalesce(F.array_position(arr, x) - 1, F.lit(-1)).cast("int"))
    if unseen == -1:
        return found
    return F.transform(found, lambda i: F.when(i < 0, F.lit(unseen)).otherwise(i))


def index_characters_with_terms(seq: Column | str, terms: Sequence[str], unseen: int = UNSEEN) -> Column:
    """``index_with_terms`` for elements of exactly one character each, as ``text.chars`` gives them.

    A character's code point is its place in an array of indices, so an element costs one access however
    many the terms; only terms past ``DENSE_CODES`` are scanned.
    """
    s = F.col(seq) if isinstance(seq, str) else seq
    codes, wide = [unseen] * DENSE_CODES, {}
    for i, t in enumerate(terms):
        if len(t) == 1 and ord(t) < DENSE_CODES:
            codes[ord(t)] = i
        elif len(t) == 1:
            wide[t] = i
    # One literal, parsed when the plan is optimized.
    table = F.split(F.lit(",".join(map(str, codes))), ",").cast("array<int>")

    def index(x: Column) -> Column:
        near = F.get(table, F.ascii(x))
        if not wide:
            return F.coalesce(near, F.lit(unseen))
        far = F.array_position(_terms_array(list(wide)), x).cast("int")
        places = F.array(*[F.lit(i) for i in wide.values()])
        return F.coalesce(near, F.get(places, far - 1), F.lit(unseen))

    return F.transform(s, index)


def index_label_with_terms(label: Column | str, terms: Sequence[str], unseen: int = UNSEEN) -> Column:
    """Label -> index; unseen or null -> ``unseen``."""
    c = F.col(label) if isinstance(label, str) else label
    pos = F.array_position(_terms_array(terms), c)
    return F.when(pos.isNull() | (pos == 0), F.lit(unseen)).otherwise(pos - 1).cast("int")


def _bloom_word(term: Column, words: int) -> Column:
    """The word of the filter that a term belongs to."""
    return F.pmod(F.xxhash64(term), F.lit(words)).cast("int")


def _bloom_mask(term: Column) -> Column:
    """``BLOOM_BITS`` bits of a 64-bit word, from a second hash of the term."""
    h = F.xxhash64(F.lit(1), term)
    mask = F.lit(0).cast("long")
    for i in range(BLOOM_BITS):
        place = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("long"), place))
    return mask


def bloom_filter(vocab: DataFrame, n_terms: int, max_words: int = BLOOM_MAX_WORDS) -> tuple[DataFrame, int]:
    """Blocked Bloom filter of the terms of ``vocab``: ``(_word, _bits)`` and the number of words.

    Built by one aggregation with map-side combine.  Words grow with the terms up to
    ``max_words``, the bound of the broadcast; past it the filter only lets more unseen terms through.
    """
    words = max(1, min(max_words, -(-n_terms // BLOOM_TERMS_PER_WORD)))
    term = F.col("term")
    return vocab.where(term.isNotNull()).groupBy(_bloom_word(term, words).alias("_word")).agg(
        F.bit_or(_bloom_mask(term)).alias("_bits")), words


def may_hold(df: DataFrame, term_col: str, bloom: DataFrame, words: int, out: str = "_maybe") -> DataFrame:
    """``df`` with ``out``: false where the filter's vocabulary surely lacks the term (null: false)."""
    term = F.col(term_col)
    mask = _bloom_mask(term)
    joined = df.withColumn("_word", _bloom_word(term, words)).join(F.broadcast(bloom), "_word", "left")
    held = F.coalesce(F.col("_bits"), F.lit(0)).bitwiseAND(mask) == mask
    return joined.withColumn(out, held & term.isNotNull()).drop("_word", "_bits")


def _look_up(df: DataFrame, term_col: str, vocab: DataFrame, broadcast_max_terms: int,
             broadcast_max_bytes: int, hot_terms: int) -> DataFrame:
    """``df`` with ``_idx``, the index of ``term_col`` (null if unseen or null)."""
    kv = vocab.select(F.col("term").alias("_term"), F.col("idx").alias("_idx"))
    term = F.col(term_col)
    if fits_broadcast(vocab, broadcast_max_terms, broadcast_max_bytes):
        return df.join(F.broadcast(kv), term == F.col("_term"), "left").drop("_term")
    is_hot = hot_entry(F.col("_idx"), F.col("_term"), hot_terms)
    hot = kv.where(is_hot)
    # A term held by many rows is answered by broadcast; null terms match nothing and skip the other
    # joins.  What follows reads this frame several times, so it is written once: the input, with the
    # splitting of its texts, is evaluated a single time.
    first = materialize(df.join(F.broadcast(hot), term == F.col("_term"), "left").drop("_term"))
    open_ = F.col("_idx").isNull() & term.isNotNull()
    hits = first.where(~open_)
    misses = first.where(open_).drop("_idx")
    tail = kv.where(~is_hot)
    heavy = misses.groupBy(term_col).count().select(
        F.sha2(term.cast("binary"), 256).alias("_key"), "count"
    ).orderBy(F.col("count").desc(), "_key").limit(hot_terms).select("_key")
    known = tail.select(F.sha2(F.col("_term").cast("binary"), 256).alias("_key"), "_idx")
    answers = heavy.join(known, "_key", "left").select("_key", F.coalesce("_idx", F.lit(-1)).alias("_a"))
    second = misses.withColumn("_key", F.sha2(term.cast("binary"), 256)).join(
        F.broadcast(answers), "_key", "left").drop("_key")
    bloom, words = bloom_filter(tail.select(F.col("_term").alias("term")), tail.count())
    checked = may_hold(second, term_col, bloom, words)
    asked = F.col("_a").isNull() & F.col("_maybe")
    settled = checked.where(~asked).withColumn("_idx", F.when(F.col("_a") >= 0, F.col("_a"))).drop(
        "_a", "_maybe")
    rest = checked.where(asked).drop("_a", "_maybe").join(tail, term == F.col("_term"), "left").drop("_term")
    return hits.unionByName(settled).unionByName(rest)


def index_labels(
    df: DataFrame, label_vocab: DataFrame, label_col: str = "label", out: str = "Y",
    unseen: int = UNSEEN, array_max_terms: int = ARRAY_MAX_TERMS,
    broadcast_max_terms: int = BROADCAST_MAX_TERMS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    hot_terms: int = HOT_TERMS,
) -> DataFrame:
    """Add the label index, for any number of labels."""
    terms = small_terms(label_vocab, array_max_terms)
    if terms is not None:
        return df.withColumn(out, index_label_with_terms(label_col, terms, unseen))
    found = _look_up(df, label_col, label_vocab, broadcast_max_terms, broadcast_max_bytes, hot_terms)
    return found.withColumn(out, F.coalesce("_idx", F.lit(unseen)).cast("int")).drop("_idx")


def index_sequences(
    df: DataFrame,
    seq_col: str,
    vocab: DataFrame,
    out: str = "X",
    row_col: str = "row_id",
    carry: Sequence[str] | None = None,
    unseen: int = UNSEEN,
    method: str = "auto",
    array_max_terms: int = ARRAY_MAX_TERMS,
    broadcast_max_terms: int = BROADCAST_MAX_TERMS,
    broadcast_max_bytes: int = BROADCAST_MAX_BYTES,
    hot_terms: int = HOT_TERMS,
) -> DataFrame:
    """Add ``out`` = indices of ``seq_col``; null sequence -> null, [] -> [].

    The array path keeps every column.  The join path returns ``row_col``,
    ``carry`` (default: every column but ``seq_col``; pass only small ones) and
    ``out``, because carried columns travel through the explode.
    """
    if method not in ("auto", "array", "join"):
        raise ValueError(method)
    if method in ("auto", "array"):
        terms = small_terms(vocab, array_max_terms)
        if terms is not None:
            return df.withColumn(out, index_with_terms(seq_col, terms, unseen))
        if method == "array":
            raise ValueError(f"vocabulary has more than {array_max_terms} terms; use the join path")
    if carry is None:
        carry = [c for c in df.columns if c not in (seq_col, row_col)]
    carry = list(carry)

    exploded = df.select(
        row_col,
        *carry,
        F.col(seq_col).isNull().alias("_null_seq"),
        F.posexplode_outer(F.col(seq_col)).alias("_pos", "term"),
    )
    looked_up = _look_up(exploded, "term", vocab, broadcast_max_terms, broadcast_max_bytes,
                         hot_terms)

    elem = F.when(
        F.col("_pos").isNotNull(),
        F.struct(F.col("_pos"), F.coalesce(F.col("_idx"), F.lit(unseen)).cast("int").alias("i")),
    )
    grouped = looked_up.groupBy(row_col, *carry, "_null_seq").agg(
        F.array_sort(F.collect_list(elem)).alias("_pairs")
    )
    return grouped.select(
        row_col,
        *carry,
        F.when(F.col("_null_seq"), F.lit(None)).otherwise(
            F.transform("_pairs", lambda p: p["i"])
        ).cast("array<int>").alias(out),
    )
