"""Benchmark decontamination by spaced-seed hashing.

Texts and benchmark items are cut into words (ASCII lower case; letters, digits and
non-ASCII).  Each fixed mask picks some of the words of a short span and ignores the others,
so a substituted word under an ignored position does not hide an overlap.  Hashes of the
picked words are looked up among the items' hashes; a hit fixes how item and document
line up, and the words along that alignment are compared one by one.  A document is contaminated when,
along some alignment, a window of ``min(WINDOW, item length)`` words agrees in at least
``SIMILARITY`` of its words.

The benchmark is the small side: it is read in blocks of at most ``BLOCK_BYTES`` of
text, each block indexed and broadcast, and every document meets every block.  The documents are
not shuffled: a long benchmark means more passes, not a larger broadcast; between passes the rows are
written, so that a task holds one block's index.  Words outside
the block's vocabulary have id 0 and are never looked up.

No allowed substitution escapes the masks: for every length of a whole item or window, each set of
substituted words that verification accepts and no placement of a fixed mask avoids gets a mask of
its own, one that ignores just these words (``short_masks``; only lengths of 5, 6, 7 and 10 words have any).
Items too short for any substitution are matched whole; items without words match nothing.
Items without an id are items of their own, reported with a null ``item_id``.  Null and empty texts are clean.  Repeated rows give repeated results,
empty tables are fine, extra columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass, fields
from functools import cache
from itertools import combinations, repeat
from math import ceil

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import DOCUMENT_COLUMNS, read, store

# Fixed masks: 1 is a word that must agree, 0 one that is ignored.
MASKS = ["111011", "1101011", "10110011"]
WINDOW = 12
SIMILARITY = 0.8
BLOCK_BYTES = 16 << 20
#: Words handled at once in a task, whatever the size of an Arrow batch.
CHUNK_WORDS = 1 << 20

_TABLE = bytes(
    c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32
    for c in range(256))
_MULTIPLIERS = (np.random.default_rng(11).integers(1, 2**63, 64, dtype=np.uint64)
                * np.uint64(2) + np.uint64(1))
_LONGEST = max(map(len, MASKS))


@cache
def short_masks(n: int) -> tuple[str, ...]:
    """Masks of ``n`` words for items of ``n`` words: they ignore just the substitutions that verification
    accepts and the fixed masks do not."""
    spared = [frozenset(s + k for k, c in enumerate(m) if c == "1")
              for m in MASKS for s in range(n - len(m) + 1)]
    most = n - ceil(SIMILARITY * n)
    lost = [frozenset(x) for k in range(most + 1) for x in combinations(range(n), k)
            if not any(s.isdisjoint(x) for s in spared)]
    # A mask that ignores more words serves every smaller set.
    lost = [x for x in lost if not any(x < y for y in lost)]
    return tuple("".join("01"[k not in x] for k in range(n)) for x in lost)


SHORT = range(1, WINDOW + 1)


def words_of(text: bytes) -> list[bytes]:
    return text.translate(_TABLE).split()


@dataclass
class Index:
    """One block of the benchmark: word ids, item texts as ids, and hashes per mask."""

    vocabulary: dict[bytes, int]
    item_ids: list[int | None]
    starts: np.ndarray  # start of each item in `ids`, plus the end
    ids: np.ndarray
    tables: list[tuple[np.ndarray, np.ndarray, np.ndarray]]  # mask offsets, sorted hashes, positions


def _hash(ids: np.ndarray, at: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k, o in enumerate(offsets):
            h += ids[at + o].astype(np.uint64) * _MULTIPLIERS[k]
        return h ^ (h >> np.uint64(29))


def build_index(items: list[tuple[int | None, str | None]]) -> Index:
    vocabulary: dict[bytes, int] = {}
    texts = [words_of((t or "").encode()) for _, t in items]
    ids = np.array([vocabulary.setdefault(w, len(vocabulary) + 1) for t in texts for w in t],
                   np.int64)
    starts = np.concatenate([[0], np.cumsum([len(t) for t in texts])]).astype(np.int64)
    lengths = np.diff(starts)
    masks = {m: lengths >= len(m) for m in MASKS}
    for n in SHORT:
        if (lengths == n).any():
            for mask in short_masks(n):
                masks[mask] = masks.get(mask, False) | (lengths == n)
    tables = []
    for mask, holds in masks.items():
        offsets = np.flatnonzero([c == "1" for c in mask])
        at = [np.arange(s, s + n - len(mask) + 1)
              for s, n, ok in zip(starts[:-1], lengths, holds, strict=True) if ok]
        at = np.concatenate(at) if at else np.zeros(0, np.int64)
        h = _hash(ids, at, offsets)
        order = np.argsort(h, kind="stable")
        tables.append((offsets, h[order], at[order]))
    return Index(vocabulary, [i for i, _ in items], starts, ids, tables)


def _alignments(index: Index, ids: np.ndarray) -> np.ndarray:
    """Distinct ``(position of an item's first word among ids, item number)`` with a hit."""
    found = []
    for offsets, hashes, positions in index.tables:
        n = len(ids) - int(offsets[-1])
        if n <= 0 or not len(hashes):
            continue
        known = ids > 0
        ok = np.ones(n, bool)
        for o in offsets:
            ok &= known[o:n + o]
        at = np.flatnonzero(ok)
        h = _hash(ids, at, offsets)
        lo, hi = np.searchsorted(hashes, h, "left"), np.searchsorted(hashes, h, "right")
        hit = np.flatnonzero(hi > lo)
        if not len(hit):
            continue
        many = hi[hit] - lo[hit]
        where = np.repeat(at[hit], many)
        first = np.repeat(lo[hit] - np.concatenate([[0], np.cumsum(many)[:-1]]), many)
        place = positions[first + np.arange(len(where))]
        item = np.searchsorted(index.starts, place, "right") - 1
        found.append(np.unique(np.stack([where - (place - index.starts[item]), item], 1), axis=0))
    return np.unique(np.concatenate(found), axis=0) if found else np.zeros((0, 2), np.int64)


def _verify(index: Index, ids: np.ndarray, shift: int, item: int) -> tuple[int, int, int] | None:
    """Words that agree along the alignment, first and last word of the windows that agree enough."""
    a, b = index.starts[item], index.starts[item + 1]
    lo, hi = max(0, -shift), min(b - a, len(ids) - shift)  # the part inside the document
    same = index.ids[a + lo:a + hi] == ids[shift + lo:shift + hi]
    w = int(min(WINDOW, b - a))
    if len(same) < w:
        return None
    sums = np.concatenate([[0], np.cumsum(same)])
    good = np.flatnonzero(sums[w:] - sums[:-w] >= SIMILARITY * w)
    if not len(good):
        return None
    return int(same.sum()), int(shift + lo + good[0]), int(shift + lo + good[-1] + w - 1)


def _judge_chunk(index: Index, docs: list[list[bytes]]) -> list[tuple | None]:
    """Per document: ``(n_items, item_id, overlap, first_word, last_word)`` of the best item."""
    gap = [0] * _LONGEST
    look, flat, starts = index.vocabulary.get, [], []
    for words in docs:
        starts.append(len(flat))
        flat.extend(map(look, words, repeat(0)))
        flat.extend(gap)
    ids = np.array(flat, np.int64)
    at = np.array(starts, np.int64)
    out: list[tuple | None] = [None] * len(docs)
    hits: dict[int, dict[tuple[bool, int], tuple]] = {}
    pairs = _alignments(index, ids)
    # A document's number: of the hit, not of the alignment, which may begin before it.
    for shift, item in pairs.tolist():
        n = int(index.starts[item + 1] - index.starts[item])
        first = max(0, int(np.searchsorted(at, shift, "right")) - 1)
        for d in range(first, len(docs)):
            if at[d] >= shift + n:
                break
            lo = starts[d]
            if got := _verify(index, ids[lo:lo + len(docs[d])], shift - lo, item):
                name = index.item_ids[item]
                key = (name is None, item if name is None else name)
                mine = hits.setdefault(d, {})
                new = (got[0] / n, got[1], got[2])
                if key not in mine or new > mine[key]:
                    mine[key] = new
    for d, mine in hits.items():
        (unnamed, item), best = max(mine.items(), key=lambda x: (x[1][0], not x[0][0], -x[0][1]))
        out[d] = (len(mine), None if unnamed else item, *best)
    return out


_FIELDS = [("n_items", pa.int64()), ("item_id", pa.int64()), ("overlap", pa.float64()),
           ("first_word", pa.int64()), ("last_word", pa.int64())]


def _judge(index: Index, texts: list[bytes | None]) -> list[tuple | None]:
    out, chunk, size = [], [], 0
    for t in texts:
        chunk.append(words_of(t or b""))
        size += len(chunk[-1])
        if size >= CHUNK_WORDS:
            out += _judge_chunk(index, chunk)
            chunk, size = [], 0
    return out + _judge_chunk(index, chunk)


def _blocks(benchmark: DataFrame, block_bytes: int) -> list[DataFrame]:
    """Blocks of the benchmark, each of about ``block_bytes`` at most; rows of one id stay together."""
    items = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text")
    size = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = max(1, -(-2 * size // block_bytes))  # half full on average, so uneven blocks stay below
    if n == 1:
        return [items]
    key = F.when(F.col("item_id").isNull(), F.xxhash64("text")).otherwise(F.xxhash64("item_id"))
    return [items.where(F.pmod(key, F.lit(n)) == b) for b in range(n)]


def find_leaks(docs: DataFrame, benchmark: DataFrame, carry: Sequence[str] = (),
               block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, contaminated, n_items, item_id, overlap, first_word, last_word`` and ``carry``.

    ``item_id`` is the item with the largest share of words that agree (the smallest such id).
    """
    cols = ["doc_id", *[c for c in carry if c != "doc_id"]]
    df = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)],
                     F.col("text").cast("binary").alias("_text"))
    kinds = {"n_items": "long", "item_id": "long", "overlap": "double",
             "first_word": "long", "last_word": "long"}
    blocks = _blocks(benchmark, block_bytes)
    for left, block in enumerate(blocks, 1 - len(blocks)):
        items = [(r[0], r[1]) for r in block.orderBy("item_id", "text").collect()]
        index = docs.sparkSession.sparkContext.broadcast(_plain(build_index(items)))
        have = set(kinds) <= set(df.columns)
        kept = df.columns if have else [*df.columns, *kinds]
        types = dict(df.dtypes) | kinds
        df = df.mapInArrow(_pass(index, have), ", ".join(f"`{c}` {types[c]}" for c in kept))
        if left:  # not the last: the next pass must not run in the same tasks
            df = store(df, "leaks")
    return df.select(
        F.col("_c0").alias("doc_id"), (F.col("n_items") > 0).alias("contaminated"), *kinds,
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols) if i])


def _plain(index: Index) -> tuple:
    """Only plain values are broadcast; executors need not have this package."""
    return tuple(getattr(index, f.name) for f in fields(index))


def _pass(block, have: bool):
    """Arrow function adding one block's verdict to the columns so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index = Index(*block.value)
        for batch in batches:
            new = [g or (0, None, None, None, None)
                   for g in _judge(index, batch.column("_text").to_pylist())]
            if have:
                old = list(zip(*(batch.column(f).to_pylist() for f, _ in _FIELDS), strict=True))
                new = [_better(a, b) for a, b in zip(old, new, strict=True)]
                batch = batch.drop_columns([f for f, _ in _FIELDS])
            for i, (f, kind) in enumerate(_FIELDS):
                batch = batch.append_column(f, pa.array([g[i] for g in new], kind))
            yield batch

    return run


def _better(a: tuple, b: tuple) -> tuple:
    """Verdicts of two blocks: items add up, the best item stays."""
    best = max((a, b), key=lambda g: (g[2] if g[0] else -1.0, g[1] is not None, -(g[1] or 0)))
    return (a[0] + b[0], *best[1:])


def filter_documents(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """Documents without contaminated ones (columns of ``documents``)."""
    found = find_leaks(docs, benchmark, DOCUMENT_COLUMNS)
    return found.where("not contaminated").select(*DOCUMENT_COLUMNS)


def op7_spaced_seeds(spark, sf_dir):
    return find_leaks(read(spark, sf_dir, "documents"), read(spark, sf_dir, "benchmark"))


QUERIES = {"op7_spaced_seeds": op7_spaced_seeds}
ORACLE_SQL: dict[str, str] = {}  # tolerant overlaps are checked by brute force in tests/llm
