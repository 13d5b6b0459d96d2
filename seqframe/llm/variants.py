"""Spelling variants: a trie of letter-group counts, searched with one surplus and one deficit.

Words of the corpus are counted, and every frequent word becomes a vector: how many of its code
points lie in each of ``GROUPS`` (successive sets of letters).  The trie's level ``i`` branches on the
count of group ``i``; its leaves hold the words of one vector.  Words that differ by one inserted, deleted
or replaced code point have vectors that differ by at most one surplus and one deficit, so a
depth-first search spends a budget of one each; the words of the leaves reached are verified.

The trie is dealt over the cluster: words are sorted by vector, and consecutive stretches of them (each a
bounded part of the trie) go to one task each.  A search first descends a directory, the first word of every
stretch, and visits only stretches that hold a vector within the budget.  Directory and stretches
are bounded together: with ``n`` words there are at most ``MAX_STRETCHES`` stretches, of
``max(STRETCH, n / MAX_STRETCHES)`` words, so the directory never outgrows some megabytes and a
stretch of a vocabulary of a billion words holds 15,000.  One vector shared by very many words spans several
stretches.  Tasks hold one stretch and read the searches as a stream; what they return is one row per
searching word and stretch (number of near words, the best one), never the pairs.

A word's form is its near word of largest count (ties: the first in code-point order) if that count is
at least ``RATIO`` times its own.  Counts at least double along forms, so there are no cycles and
a chain has at most 63 steps; roots come by pointer jumping.

Null texts hold no words; a null ``doc_id`` counts as an empty number; repeated rows count as often as they
occur; an empty table gives an empty result; texts of any length are read whole; further columns are
ignored.
"""

from __future__ import annotations

import re
import zlib
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import read, store
from seqframe.operators.numbering import dense_index

MIN_LENGTH = 5
MIN_COUNT = 3
EVERY = 97
RATIO = 2
STRETCH = 4096
MAX_STRETCHES = 1 << 16
LEAF = 4
#: Words of one vector that travel together; pairs of words verified at once; rows of an output batch.
MAX_LIST = 16
BLOCK_PAIRS = 1 << 20
OUT_ROWS = 10_000
#: Distinct words of a batch counted in memory before they are sent on.
FLUSH = 200_000

# Letter groups, commonest letters alone so that the upper levels branch; all else is the last group.
GROUPS = ["e", "n", "i", "t", "a", "r", "s", "o", "u", "l", "d", "h", "c", "m", "g", "p", "b", "f", "v",
          "k", "y", "w", "z", "q", "j", "x",
          "àáâãäå", "èéêë", "ìíîï",
          "òóôõö", "ùúûü", "ßçñ"]
LEVELS = len(GROUPS) + 1
_GROUP = np.full(256, LEVELS - 1)
for _g, _letters in enumerate(GROUPS):
    _GROUP[[ord(c) for c in _letters]] = _g

_RUN = re.compile("[A-Za-zÀ-ÿ]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def observed(doc_id: int | None, run: str) -> str:
    """A lower-cased run as it is counted: one in ``EVERY`` loses a code point."""
    name = "" if doc_id is None else str(doc_id)
    h = zlib.crc32(f"{name}:{run}".encode())
    if h % EVERY:
        return run
    at = h % len(run)
    return run[:at] + run[at + 1:]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts per batch, so that a common word is one row a batch."""

    def out(counts: Counter) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays(
            [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], ["word", "n"])

    for batch in batches:
        total: Counter = Counter()
        for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            for run, n in Counter(_RUN.findall(text or "")).items():
                if len(run) >= MIN_LENGTH:
                    lower = run.lower() if run.isascii() else run.translate(_LOWER)
                    total[observed(doc_id, lower)] += n
            if len(total) > FLUSH:
                yield out(total)
                total = Counter()
        yield out(total)


def vocabulary(docs: DataFrame, min_count: int = MIN_COUNT) -> DataFrame:
    """``word, n`` of the words long and frequent enough."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return rows.mapInArrow(_count, "word string, n long").where(
        F.char_length("word") >= MIN_LENGTH).groupBy("word").agg(F.sum("n").alias("n")).where(
        F.col("n") >= min_count)


def vectors(words: list[str]) -> np.ndarray:
    """Code points of each word in each letter group, a row of ``LEVELS`` bytes a word.

    Counts stop at 255: that brings vectors closer, never farther apart, so no near word is lost.
    """
    codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    rows = np.repeat(np.arange(len(words)), lengths)
    counts = np.bincount(rows * LEVELS + _GROUP[codes], minlength=len(words) * LEVELS)
    return np.minimum(counts, 255).astype(np.uint8).reshape(len(words), LEVELS)


def near(a: str, b: str) -> bool:
    """Exactly one inserted, deleted or replaced code point apart."""
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    half = len(a) // 2  # the one edit leaves one of the halves alone
    if a[:half] != b[:half] and a[half:] != b[len(b) - len(a) + half:]:
        return False
    lo, hi = 0, len(a)  # length of the common start
    while lo < hi:
        mid = (lo + hi + 1) // 2
        lo, hi = (mid, hi) if a[lo:mid] == b[lo:mid] else (lo, mid - 1)
    return a[lo + (len(a) == len(b)):] == b[lo + 1:]


def _afford(count: int, have: np.ndarray, surplus: np.ndarray, deficit: np.ndarray) -> np.ndarray:
    """Which searches may descend to a child of ``count``."""
    return (have == count) | ((have == count - 1) & surplus) | ((have == count + 1) & deficit)


def search(trie: np.ndarray, wanted: np.ndarray) -> Iterator[tuple[np.ndarray, int]]:
    """Depth-first search for all of ``wanted`` (vectors) at once; yields the numbers of the searches that
    reach a row of ``trie`` within a budget of one surplus and one deficit, and that row.

    ``trie`` holds the vectors in ascending order, so a node is a stretch of rows with one prefix and its
    children are the runs of the next column.  Below ``LEAF`` rows the remaining counts are compared
    directly.
    """
    mine, sought = trie.astype(np.int16), wanted.astype(np.int16)
    everyone = np.ones(len(sought), bool)
    stack = [(0, len(mine), 0, np.arange(len(sought)), everyone, everyone)]
    while stack:
        lo, hi, level, who, surplus, deficit = stack.pop()
        if hi - lo <= LEAF or level == LEVELS:
            for row in range(lo, hi):
                apart = mine[row, level:] - sought[who, level:]
                fits = (np.maximum(apart, 0).sum(1) <= surplus) & (np.maximum(-apart, 0).sum(1) <= deficit)
                if len(found := who[fits]):
                    yield found, row
            continue
        column, have = mine[lo:hi, level], sought[who, level]
        starts = [0, *(np.flatnonzero(np.diff(column)) + 1).tolist()] if column[0] != column[-1] else [0]
        for a, b in zip(starts, [*starts[1:], hi - lo], strict=True):
            count = column[a]
            ok = _afford(count, have, surplus, deficit)
            if ok.any():
                h = have[ok]
                stack.append((lo + a, lo + b, level + 1, who[ok], surplus[ok] & (h >= count),
                              deficit[ok] & (h <= count)))


def stretches(firsts: list[bytes], wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs of a search's number and a stretch that can hold a vector within its budget.

    ``firsts`` is the directory: each stretch's first vector, ascending.  The descent narrows the
    stretches in which a prefix can lie and stops as soon as one is left.
    """
    found = []
    everyone = np.ones(len(wanted), bool)
    sought = wanted.astype(np.int16)
    stack = [(b"", 0, len(firsts), np.arange(len(wanted)), everyone, everyone)]
    while stack:
        prefix, lo, hi, who, surplus, deficit = stack.pop()
        first = max(0, lo - 1)  # a prefix may begin inside the stretch before
        if hi - first <= 1 or len(prefix) == LEVELS:
            found += [(who, np.full(len(who), k)) for k in range(first, hi)]
            continue
        have = sought[who, len(prefix)]
        for count in range(max(0, int(have.min()) - 1), min(255, int(have.max()) + 1) + 1):
            ok = _afford(count, have, surplus, deficit)
            if ok.any():
                p, h = prefix + bytes([count]), have[ok]
                after = prefix + bytes([count + 1]) if count < 255 else prefix + b"\xff" * (LEVELS + 1)
                stack.append((p, bisect_left(firsts, p, lo, hi), bisect_left(firsts, after, lo, hi), who[ok],
                              surplus[ok] & (h >= count), deficit[ok] & (h <= count)))
    if not found:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return tuple(np.unique(np.stack([np.concatenate(x) for x in zip(*found, strict=True)]), axis=1))


def _with_vectors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [v.tobytes() for v in vectors(batch.column("word").to_pylist())]
        yield batch.append_column("v", pa.array(found, pa.binary()))


def _matrix(batch: pa.RecordBatch) -> np.ndarray:
    return np.frombuffer(b"".join(batch.column("v").to_pylist()), np.uint8).reshape(-1, LEVELS)


_DEALT = pa.schema([("stretch", pa.int64()), ("v", pa.binary()), ("words", pa.list_(pa.string())),
                    ("ns", pa.list_(pa.int64()))])


def _deal(directory):
    """Rows ``stretch, v, words, ns`` of words with one vector: once where they lie (with ``ns``, their
    counts), and once for each stretch to search for them (``ns`` null)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        firsts = directory.value
        for batch in batches:
            rows: dict[tuple, list[list]] = {}  # lists of at most MAX_LIST words
            for word, n, v, home in zip(*(batch.column(c).to_pylist() for c in ("word", "n", "v", "stretch")),
                                        strict=True):
                mine = rows.setdefault((v, home), [])
                if not mine or len(mine[-1]) == MAX_LIST:
                    mine.append([])
                mine[-1].append((word, n))
            flat = [(home, v, *map(list, zip(*some, strict=True)))
                    for (v, home), mine in rows.items() for some in mine]
            if not flat:
                continue
            who, where = stretches(firsts, np.frombuffer(
                b"".join(r[1] for r in flat), np.uint8).reshape(-1, LEVELS))
            home = pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*flat, strict=True), _DEALT, strict=True)],
                schema=_DEALT)
            yield home
            for k in range(0, len(who), OUT_ROWS):
                some = home.take(pa.array(who[k:k + OUT_ROWS], pa.int64()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(where[k:k + OUT_ROWS], pa.int64()), some.column("v"), some.column("words"),
                     pa.nulls(some.num_rows, _DEALT.field("ns").type)], schema=_DEALT)

    return run


class Words:
    """Lists of words one after another: start of each list, and each word's first and last code points."""

    def __init__(self, lists: list[list[str]]):
        self.starts = np.cumsum([0, *map(len, lists)])
        self.words = [w for x in lists for w in x]
        ends = np.array([[*map(ord, w[:3]), *map(ord, w[-3:])] for w in self.words], np.int64).reshape(-1, 6)
        self.head2, self.tail2 = ends[:, :2] @ [1, 256], ends[:, 4:] @ [1, 256]
        self.head3, self.tail3 = self.head2 + 65536 * ends[:, 2], ends[:, 3:] @ [1, 256, 65536]


def _pairs(mine: Words, i: np.ndarray, theirs: Words, j: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Words of lists ``i`` with words of lists ``j`` that may be near.

    Of five code points or more, an edit leaves the first two or the last three, and the first three or
    the last two, as they are.
    """
    n = np.diff(theirs.starts)[j]
    many = np.diff(mine.starts)[i] * n
    at = np.arange(many.sum()) - np.repeat(np.cumsum(many) - many, many)
    n = np.repeat(n, many)
    a, b = np.repeat(mine.starts[i], many) + at // n, np.repeat(theirs.starts[j], many) + at % n
    ok = ((mine.head2[a] == theirs.head2[b]) | (mine.tail3[a] == theirs.tail3[b])) & (
        (mine.head3[a] == theirs.head3[b]) | (mine.tail2[a] == theirs.tail2[b]))
    return a[ok], b[ok]


def near_words(trie: np.ndarray, known: Words, counts: list[int], wanted: np.ndarray,
               sought: Words) -> list[tuple]:
    """``word, n_near, form, form_n`` of the sought words that have a near word in this stretch."""
    best: dict[int, tuple[int, int, str]] = {}

    def verify(found: list[tuple[np.ndarray, int]]) -> None:
        if not found:
            return
        lists = np.concatenate([who for who, _ in found])
        rows = np.repeat([row for _, row in found], [len(who) for who, _ in found])
        a, b = _pairs(sought, lists, known, rows)
        for x, y in zip(a.tolist(), b.tolist(), strict=True):
            if near(sought.words[x], other := known.words[y]):
                n, least, form = best.get(x, (0, 1, ""))
                best[x] = n + 1, *min((least, form), (-counts[y], other))

    found, held, size, length = [], 0, np.diff(sought.starts), np.diff(known.starts)
    for who, row in search(trie, wanted):
        found.append((who, row))
        held += int(size[who].sum() * length[row])
        if held > BLOCK_PAIRS:
            verify(found)
            found, held = [], 0
    verify(found)
    return [(sought.words[x], n, form, -least) for x, (n, least, form) in best.items()]


_FOUND = pa.schema([("word", pa.string()), ("n_near", pa.int64()), ("form", pa.string()),
                    ("form_n", pa.int64())])


def _search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come by stretch, its words in order before the searches."""
    now, parts, trie = None, [], None
    for batch in batches:
        rows = []
        stretch = batch.column("stretch").to_numpy()
        known = batch.column("ns").is_valid().to_numpy(zero_copy_only=False)
        bounds = (np.flatnonzero((np.diff(stretch) != 0) | (np.diff(known) != 0)) + 1).tolist()
        for a, b in zip([0, *bounds], [*bounds, batch.num_rows], strict=True):
            if a == b:
                continue
            part = batch.slice(a, b - a)
            if stretch[a] != now:
                now, parts, trie = stretch[a], [], None
            if known[a]:
                parts.append(part)
                continue
            if trie is None:
                trie = (np.concatenate([_matrix(p) for p in parts]),
                        Words([x for p in parts for x in p.column("words").to_pylist()]),
                        [n for p in parts for x in p.column("ns").to_pylist() for n in x])
            rows += near_words(*trie, _matrix(part), Words(part.column("words").to_pylist()))
        cols = list(zip(*rows, strict=True)) or [[]] * len(_FOUND)
        yield pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(cols, _FOUND, strict=True)], schema=_FOUND)


def nearest(words: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``word, n_near, form, form_n`` of the words (``word, n``) with a near one; ``form`` is the near word
    of largest ``n``, the first in code-point order of several."""
    spark = words.sparkSession
    placed = dense_index(words.mapInArrow(_with_vectors, "word string, n long, v binary"),
                         [F.col("v"), F.col("word")], out="at")
    total = placed.count()
    size = max(stretch, -(-total // MAX_STRETCHES))
    placed = store(placed.withColumn("stretch", F.floor(F.col("at") / size).cast("long")), "placed")
    first = placed.where(F.col("at") % size == 0).select("at", "v").orderBy("at").collect()
    directory = spark.sparkContext.broadcast([bytes(r["v"]) for r in first])
    dealt = placed.mapInArrow(
        _deal(directory), "stretch long, v binary, words array<string>, ns array<long>")
    tasks = max(int(spark.conf.get("spark.sql.shuffle.partitions")), len(first) // 8)
    dealt = dealt.repartition(tasks, "stretch").sortWithinPartitions("stretch", F.col("ns").isNull(), "v")
    found = dealt.mapInArrow(_search, "word string, n_near long, form string, form_n long")
    best = F.min(F.struct((-F.col("form_n")).alias("m"), F.col("form").alias("w")))
    return found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best.alias("_b")).select(
        "word", "n_near", F.col("_b.w").alias("form"), (-F.col("_b.m")).alias("form_n"))


def roots(forms: DataFrame) -> DataFrame:
    """``word, root`` of ``word, form`` (no cycles): pointer jumping, a chain halves each round."""
    now = store(forms.select("word", F.col("form").alias("root")), "roots")
    while True:
        to = now.select(F.col("word").alias("_w"), F.col("root").alias("_r"))
        jumped = store(now.join(to, F.col("root") == F.col("_w"), "left").select(
            "word", F.coalesce("_r", "root").alias("root"), F.col("_r").isNotNull().alias("_moved")), "roots")
        now = jumped.select("word", "root")
        if jumped.where("_moved").isEmpty():
            return now


def group_variants(words: DataFrame, stretch: int = STRETCH) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for every word of ``word, n``."""
    words = store(words.select("word", "n"), "words")
    known = words.join(nearest(words, stretch), "word", "left")
    held = F.col("form_n") >= RATIO * F.col("n")
    known = store(known.select(
        "word", F.when(held, F.col("form")).alias("form"), "n",
        F.coalesce("n_near", F.lit(0)).cast("long").alias("n_near"),
        F.when(held, F.col("form_n")).alias("form_n")), "forms")
    last = roots(known.where("form is not null").select("word", "form"))
    return known.join(last, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def op13_variants(spark, sf_dir):
    return group_variants(vocabulary(read(spark, sf_dir, "documents")))


QUERIES = {"op13_variants": op13_variants}
ORACLE_SQL: dict[str, str] = {}  # checked against all pairs of words in tests/llm
