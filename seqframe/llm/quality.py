"""Quality rules with cross-document line frequency.

One Arrow pass over the texts computes the per-document figures and the distinct
normalised lines (ASCII lower case, digits as 0, white space collapsed) as 64-bit hashes
with their words.  Spark then counts, for every host (``source``) and line, the
distinct documents holding it; exact copies of a text within a host count once, so a
line is frequent because many different documents carry it.  A line is over the limit when more
than ``MIN_DOCS`` documents have it, whatever the size of the host.  Such lines are removed; a document left with fewer than ``MIN_WORDS`` words, or with less than ``MIN_LEFT`` of its
words, is depleted and rejected.

The counting is a grouped sum with map-side combine, and a line shared by a third of a
host's documents is met by the other side's single row, so a skewed join can be split; the
list of lines over the limit is broadcast only when its counted size allows it.

Null and empty texts have no words and fail the base rule.  A null source is a host of its
own.  Repeated rows give repeated results; empty tables are fine; extra columns are
ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import DOCUMENT_COLUMNS, read, source_key
from seqframe.session import materialize

MIN_WORDS = 20
MAX_REPEAT_PERCENT = 30
WINDOW = 8
MIN_DOCS = 20
MIN_LEFT = 0.3
BROADCAST_LINES = 500_000

SYMBOLS = b"#*$%&|<>"
_CONTINUATION = bytes(range(0x80, 0xC0))
_NORMAL = bytes(
    c + 32 if 65 <= c <= 90 else 48 if 48 <= c <= 57 else c for c in range(256))
_RNG = np.random.default_rng(5)
_MULTIPLIERS = _RNG.integers(1, 2**63, WINDOW, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def line_hash(line: bytes) -> int:
    """64-bit hash of a line's normal form; 0 for a line without a word."""
    words = line.translate(_NORMAL).split()
    if not words:
        return 0
    d = hashlib.blake2b(b" ".join(words), digest_size=8).digest()
    return int.from_bytes(d, "little", signed=True) or 1


def repeated_words(words: list[bytes], window: int = WINDOW) -> int:
    """Words inside ``window``-word runs that occur at least twice (all occurrences)."""
    n = len(words) - window + 1
    if n < 2:
        return 0
    names: dict[bytes, int] = {}
    ids = np.fromiter((names.setdefault(w, len(names)) for w in words), np.uint64, len(words))
    with np.errstate(over="ignore"):
        h = ids[:n] * _MULTIPLIERS[0]
        for k in range(1, window):
            h += ids[k:n + k] * _MULTIPLIERS[k]
    s = np.sort(h)
    if not (s[1:] == s[:-1]).any():  # no equal hash, so no equal run
        return 0
    # Exact names of runs by doubling: a pair of names gets one name.
    name, size = ids.astype(np.int64), 1
    while size < window:
        pair = name[:len(name) - size] * np.int64(len(words) + 1) + name[size:]
        name, size = np.unique(pair, return_inverse=True)[1].astype(np.int64), size * 2
    again = np.flatnonzero(np.bincount(name)[name] > 1)
    cover = np.zeros(len(words) + 1, np.int64)
    np.add.at(cover, again, 1)
    np.add.at(cover, again + window, -1)
    return int((np.cumsum(cover) > 0).sum())


_MEASURED = pa.schema([
    ("doc_id", pa.int64()), ("_sk", pa.string()), ("_t", pa.binary()), ("_k", pa.binary()),
    ("n_words", pa.int64()), ("word_chars", pa.int64()), ("n_symbols", pa.int64()),
    ("n_dup_lines", pa.int64()), ("n_repeat_words", pa.int64()),
    ("lines", pa.list_(pa.int64())), ("line_words", pa.list_(pa.int64()))])


def _digests(doc_id, sk: str, text: bytes) -> tuple[bytes, bytes]:
    """Digest of the text, and of the whole row (equal rows share it)."""
    t = hashlib.blake2b(text, digest_size=16).digest()
    return t, hashlib.blake2b(f"{doc_id}|{sk}|".encode() + t, digest_size=16).digest()


def _measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for doc_id, sk, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or b""
            words = text.split()
            seen: set[bytes] = set()
            dup, lines = 0, {}
            for line in text.split(b"\n"):
                if not (n := len(line.split())):
                    continue
                if line in seen:
                    dup += 1
                seen.add(line)
                h = line_hash(line)
                lines[h] = lines.get(h, 0) + n
            rows.append((
                doc_id, sk, *_digests(doc_id, sk, text), len(words),
                len(b"".join(words).translate(None, _CONTINUATION)),
                len(text) - len(text.translate(None, SYMBOLS)), dup, repeated_words(words),
                list(lines), list(lines.values())))
        cols = list(zip(*rows, strict=True)) or [[]] * len(_MEASURED)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, _MEASURED, strict=True)], schema=_MEASURED)


def _spark_schema(schema: pa.Schema) -> str:
    names = {pa.int64(): "long", pa.string(): "string", pa.binary(): "binary",
             pa.list_(pa.int64()): "array<long>"}
    return ", ".join(f"{f.name} {names[f.type]}" for f in schema)


def measure(docs: DataFrame) -> DataFrame:
    """Per-document figures and lines; written once, far smaller than the texts."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       source_key(F.col("source")).alias("_sk"),
                       F.col("text").cast("binary").alias("text"))
    return materialize(rows.mapInArrow(_measure, _spark_schema(_MEASURED)))


def frequent_lines(measured: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_sk, _h, n_docs`` of the lines over the limit on their host."""
    lines = measured.select("_sk", "_t", F.explode("lines").alias("_h"))
    counts = lines.groupBy("_sk", "_h").agg(F.count_distinct("_t").alias("n_docs"))
    return counts.where(F.col("n_docs") > min_docs)


def judge(docs: DataFrame, min_docs: int = MIN_DOCS) -> DataFrame:
    """All figures, ``base_failed``, ``n_removed_words``, ``removed`` (line hashes), ``kept`` and
    the row digest ``_k``; one row per document row."""
    measured = measure(docs)
    frequent = materialize(frequent_lines(measured, min_docs))
    hot = F.broadcast(frequent) if frequent.count() <= BROADCAST_LINES else frequent
    zipped = F.explode(F.arrays_zip(F.col("lines").alias("h"), F.col("line_words").alias("w")))
    cut = (
        measured.select("_k", "_sk", zipped.alias("_l"))
        .select("_k", "_sk", F.col("_l.h").alias("_h"), F.col("_l.w").alias("_w"))
        .join(hot, ["_sk", "_h"])
        .groupBy("_k", "_h").agg(F.max("_w").alias("_w"))  # equal rows count once
        .groupBy("_k").agg(F.sum("_w").alias("_cut"), F.collect_list("_h").alias("removed")))
    judged = measured.drop("lines", "line_words", "_t", "_sk").join(cut, "_k", "left")
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEAT_PERCENT * F.col("n_words"))
    left = F.col("n_words") - F.coalesce("_cut", F.lit(0))
    depleted = (left < MIN_WORDS) | (left < MIN_LEFT * F.col("n_words"))
    return judged.select(
        "_k", "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        failed.alias("base_failed"), (~failed & ~depleted).alias("kept"),
        F.coalesce("_cut", F.lit(0)).cast("long").alias("n_removed_words"), "removed")


def _clean(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Drop a row's removed lines from its text."""
    for batch in batches:
        at, gone = batch.schema.get_field_index("text"), batch.column("_removed").to_pylist()
        texts = []
        for t, r in zip(batch.column(at).to_pylist(), gone, strict=True):
            if t is not None and r:
                r = set(r)
                t = "\n".join(x for x in t.split("\n") if line_hash(x.encode()) not in r)
            texts.append(t)
        out = batch.set_column(at, "text", pa.array(texts, pa.string()))
        yield out.drop_columns(["_removed"])


def filter_documents(docs: DataFrame) -> DataFrame:
    """Kept documents without their removed lines (columns of ``documents``)."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    verdict = judge(rows).where("kept").select("doc_id", "_k", F.col("removed").alias("_removed"))
    # Rows equal in id, source and text are one row in the verdict's eyes.
    verdict = verdict.dropDuplicates(["_k"])
    joined = rows.mapInArrow(_keyed, "doc_id long, text string, lang string, source string, "
                                     "n_chars long, _k binary")
    kept = joined.join(verdict.drop("doc_id"), "_k").drop("_k")
    changed = kept.where("_removed is not null").mapInArrow(
        _clean, "doc_id long, text string, lang string, source string, n_chars long")
    changed = changed.withColumn("n_chars", F.length("text").cast("long"))
    return kept.where("_removed is null").drop("_removed").unionByName(changed)


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = [
            _digests(i, "n" if s is None else f"s{s}", (t or "").encode())[1]
            for i, t, s in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "source")),
                               strict=True)]
        yield batch.append_column("_k", pa.array(keys, pa.binary()))


def op3_line_frequency(spark, sf_dir):
    return judge(read(spark, sf_dir, "documents")).drop("_k", "removed")


QUERIES = {"op3_line_frequency": op3_line_frequency}
ORACLE_SQL: dict[str, str] = {}  # runs of eight words are checked by brute force in tests/llm
