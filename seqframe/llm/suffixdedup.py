"""Exact substring removal by blockwise suffix construction with a difference cover.

A byte is removed when a string of ``LENGTH`` bytes covers it that also starts earlier in the corpus
(smaller id, or same document and earlier).  What the result needs from a suffix array is
which suffixes agree in their first LENGTH bytes and which of them comes first, so suffixes are ordered
by their LENGTH-byte prefixes (bucket by bucket, in a 62-bit order of prefixes) and never beyond.

* Cover sample.  ``COVER`` is a difference cover modulo ``PERIOD``: for any two positions some shift below
  PERIOD takes both to sampled positions.  Two equal prefixes therefore contain, at one
  such shift, two equal sample blocks of ``LENGTH - PERIOD + 1`` bytes.  Sampled blocks (19 % of the
  positions) are sorted one bucket at a time, which ranks each as alone or tied.
* Suffix buckets.  A suffix whose sample blocks are all alone cannot tie and is not
  sorted at all.  The others are cut into buckets, each sorted by one task; within a
  run of ties the smallest (id, start) stays, every other suffix is a repeat.
* Texts travel once: packed by chunks (zstd) into a table bucketed by chunk, which every later step
  reads in place.  Only ranks travel: 4 bytes per sampled block as sorted differences,
  7 bytes per suffix that may tie, bitmaps back.  A chunk sends each prefix once, so a passage
  found in a third of all documents costs a bucket one entry per chunk.
* Later exact copies of a whole text are settled by their digest and left out of all sorting.

Prefixes are compared by hash: 62 bits here (7 bytes and the bucket), the bucket count growing with
the corpus; README.md states the odds.  Memory: a chunk (``CHUNK`` bytes, or one longer document,
times about 20) or a bucket (about ``BUCKET`` bytes of text) at a time.

Null and empty texts have 0 bytes.  A null id is the smallest.  Of rows with one id, any may count as
the earlier; equal rows count as copies, one stays.  Extra columns are ignored; an empty table
gives an empty result.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import read, store
from seqframe.session import scratch_dir

LENGTH = 100
# A difference cover modulo 31 (every difference occurs).
PERIOD, COVER = 31, [1, 5, 11, 24, 25, 27]
SAMPLE_LENGTH = LENGTH - PERIOD + 1
CHUNK = 4 << 20
BUCKET = 16 << 20
SEGMENT = 1 << 16
NULL_ID = -(1 << 63)

_RNG = np.random.default_rng(31)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = 0x9E3779B97F4A7C15


def _power(e: int) -> np.uint64:
    return np.uint64(pow(_BASE, e, 1 << 64))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(32))) * np.uint64(0xD6E8FEB86659FD93)
    return x ^ (x >> np.uint64(32))


def prefix_hashes(data: np.ndarray, positions: np.ndarray, length: int) -> np.ndarray:
    """64-bit hashes of ``data[p:p+length]`` for sorted positions, in segments that stay in cache.

    Hashes of 2, 4, 8 ... bytes come from two of half the length; binary digits of ``length``
    are then put together at the wanted positions only.
    """
    out = np.empty(len(positions), np.uint64)
    bits = [1 << b for b in range(length.bit_length()) if length >> b & 1][::-1]
    with np.errstate(over="ignore"):
        for s in range(0, len(data), SEGMENT):
            lo, hi = np.searchsorted(positions, (s, s + SEGMENT))
            if lo == hi:
                continue
            at = positions[lo:hi] - s
            h, parts, size = _BYTE[data[s:s + SEGMENT + length]], {}, 1
            while True:
                if size in bits:
                    parts[size] = h
                if size == bits[0]:
                    break
                h, size = h[:-size] * _power(size) + h[size:], size * 2
            acc, done = np.zeros(len(at), np.uint64), 0
            for b in bits:
                acc = acc * _power(b) + parts[b][at + done]
                done += b
            out[lo:hi] = _mixed(acc)
    return out


def _squeeze(a: np.ndarray, width: int) -> bytes:
    """zstd of the low ``width`` bytes of each value, one byte plane after another."""
    planes = a.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :width].T
    return zstandard.ZstdCompressor(level=1).compress(np.ascontiguousarray(planes).tobytes())


def _expand(z: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8).reshape(width, -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, :width] = raw.T
    return out.view("<u8").ravel()


def _bits(flags: np.ndarray) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(np.packbits(flags).tobytes())


def _flags(z: bytes, n: int) -> np.ndarray:
    raw = np.frombuffer(zstandard.ZstdDecompressor().decompress(z), np.uint8)
    return np.unpackbits(raw, count=n).astype(bool)


_PACKED = ("chunk long, ids array<long>, lens array<long>, digests array<binary>, z binary")


def _pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Chunks of whole texts, in the order (id, digest) within a chunk."""
    base, n = TaskContext.get().partitionId() << 33, 0
    docs: list[tuple] = []
    size = 0

    def chunk():
        docs.sort(key=lambda d: d[:2])
        z = zstandard.ZstdCompressor(level=3).compress(b"".join(d[2] for d in docs))
        return pa.RecordBatch.from_arrays(
            [pa.array([base + n], pa.int64()), pa.array([[d[0] for d in docs]], pa.list_(pa.int64())),
             pa.array([[len(d[2]) for d in docs]], pa.list_(pa.int64())),
             pa.array([[d[1] for d in docs]], pa.list_(pa.binary())), pa.array([z], pa.binary())],
            ["chunk", "ids", "lens", "digests", "z"])

    for batch in batches:
        for doc_id, text in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            text = text or b""
            docs.append((NULL_ID if doc_id is None else doc_id,
                         hashlib.blake2b(text, digest_size=16).digest(), text))
            size += len(text)
            if size >= CHUNK:
                yield chunk()
                docs, size, n = [], 0, n + 1
    if docs:
        yield chunk()


class _Chunk:
    """A chunk's texts, with the positions of the documents that take part in sorting."""

    def __init__(self, lens: list[int], z: bytes, skip: list[int] | None):
        size = sum(lens)
        raw = zstandard.ZstdDecompressor().decompress(z, max_output_size=max(1, size))
        self.data = np.frombuffer(raw, np.uint8)
        self.raw, self.lens = raw, np.array(lens, np.int64)
        self.starts = np.concatenate([[0], np.cumsum(self.lens)]).astype(np.int64)
        self.active = np.ones(len(lens), bool)
        self.active[skip or []] = False

    def _positions(self, pattern: np.ndarray, length: int) -> np.ndarray:
        """``start + pattern`` of the active documents, as far as ``length`` bytes remain."""
        found = [
            s + pattern[:np.searchsorted(pattern, n - length, "right")]
            for s, n, on in zip(self.starts[:-1].tolist(), self.lens.tolist(), self.active.tolist(),
                                strict=True) if on and n >= LENGTH]
        return np.concatenate(found) if found else np.zeros(0, np.int64)

    def samples(self) -> tuple[np.ndarray, np.ndarray]:
        """Sampled positions and the hashes of their blocks."""
        longest = np.arange(int(self.lens.max(initial=0)))
        at = self._positions(longest[np.isin(longest % PERIOD, COVER)], SAMPLE_LENGTH)
        return at, prefix_hashes(self.data, at, SAMPLE_LENGTH)

    def suffixes(self, tied: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions that have a tied sample within PERIOD, and the hashes of their prefixes."""
        near = np.zeros(len(self.data) + 1, np.int32)
        np.add.at(near, np.maximum(tied - PERIOD + 1, 0), 1)
        np.add.at(near, tied + 1, -1)
        near = np.cumsum(near[:-1]) > 0
        ends = np.zeros(len(self.data) + 1, np.int32)  # only where LENGTH bytes remain
        ok = self.active & (self.lens >= LENGTH)
        ends[self.starts[:-1][ok]] += 1
        np.add.at(ends, self.starts[1:][ok] - LENGTH + 1, -1)
        at = np.flatnonzero(near & (np.cumsum(ends[:-1]) > 0))
        return at, prefix_hashes(self.data, at, LENGTH)


def _unique(h: np.ndarray):
    """``(values, index of first occurrence, first flags)`` of unsorted hashes, first in order."""
    order = np.argsort(h, kind="stable")
    s = h[order]
    new = np.ones(len(s), bool)
    new[1:] = s[1:] != s[:-1]
    first = np.zeros(len(h), bool)
    first[order[new]] = True
    return order, new, first


def _bucket_of(h: np.ndarray, buckets: int) -> np.ndarray:
    """Buckets are ranges of the hash's upper 32 bits."""
    return ((h >> np.uint64(32)) * np.uint64(buckets)) >> np.uint64(32)


class _Samples:
    """Sample hashes of a chunk, ordered, with what is sent of them per bucket."""

    def __init__(self, chunk: _Chunk, buckets: int):
        self.at, h = chunk.samples()
        self.order, self.new, _ = _unique(h)
        self.values = h[self.order][self.new]
        edges = np.searchsorted(_bucket_of(self.values, buckets), np.arange(buckets + 1))
        self.edges = edges.tolist()

    def payloads(self):
        for b in range(len(self.edges) - 1):
            lo, hi = self.edges[b], self.edges[b + 1]
            if lo < hi:
                # 32 bits inside a bucket, sent as differences of the sorted values.
                v = (self.values[lo:hi] >> np.uint64(20)) & np.uint64(0xFFFFFFFF)
                yield b, hi - lo, _squeeze(np.diff(np.sort(v), prepend=np.uint64(0)), 4), v

    def tied(self, answers: dict[int, bytes]) -> np.ndarray:
        """Positions of samples that are equal to another one, here or in another chunk."""
        again = np.zeros(len(self.values), bool)
        for b, n, _, v in self.payloads():
            if b in answers:
                rank = np.empty(n, np.int64)
                rank[np.argsort(v, kind="stable")] = np.arange(n)
                again[self.edges[b]:self.edges[b + 1]] = _flags(answers[b], n)[rank]
        if not len(self.at):
            return self.at
        group = np.cumsum(self.new) - 1
        count = np.bincount(group)
        hit = again[group] | (count[group] > 1)
        return np.sort(self.at[self.order[hit]])


class _Suffixes:
    """Suffixes of a chunk that may tie; the first of each is sent, in the order of documents."""

    def __init__(self, chunk: _Chunk, tied: np.ndarray, buckets: int):
        self.at, h = chunk.suffixes(tied)
        _, _, self.first = _unique(h)
        self.sent = np.flatnonzero(self.first)
        self.h = h[self.sent]
        self.bucket = _bucket_of(self.h, buckets).astype(np.int64)
        self.doc = np.searchsorted(chunk.starts, self.at[self.sent], "right") - 1
        self.by_bucket = np.argsort(self.bucket, kind="stable")
        self.edges = np.searchsorted(self.bucket[self.by_bucket], np.arange(buckets + 1)).tolist()

    def payloads(self, ids: np.ndarray):
        for b in range(len(self.edges) - 1):
            mine = self.by_bucket[self.edges[b]:self.edges[b + 1]]
            if len(mine):
                docs, counts = np.unique(self.doc[mine], return_counts=True)
                yield (b, len(mine), _squeeze(self.h[mine] & np.uint64((1 << 56) - 1), 7),
                       _squeeze(ids[docs].view(np.uint64), 8), _squeeze(counts.astype(np.uint64), 4))

    def repeats(self, answers: dict[int, bytes]) -> np.ndarray:
        """Positions of suffixes that are not the first of their kind in the corpus."""
        later = np.zeros(len(self.sent), bool)
        for b, z in answers.items():
            mine = self.by_bucket[self.edges[b]:self.edges[b + 1]]
            later[mine] = _flags(z, len(mine))
        gone = ~self.first
        gone[self.sent[later]] = True
        return self.at[gone]


def _rank_samples(rows: pa.Table) -> pa.Table:
    """One bucket of sample blocks: which of each chunk's blocks are tied with another chunk's."""
    parts = [np.cumsum(_expand(z, 4)) for z in rows.column("z").to_pylist()]
    every = np.sort(np.concatenate(parts))
    twice = every[1:][every[1:] == every[:-1]]
    out = []
    for p in parts:
        i = np.minimum(np.searchsorted(twice, p), max(0, len(twice) - 1))
        out.append(_bits(twice[i] == p if len(twice) else np.zeros(len(p), bool)))
    return pa.table({"chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
                     "z": pa.array(out, pa.binary())})


def _sort_suffixes(rows: pa.Table) -> pa.Table:
    """One bucket of suffixes: which of each chunk's suffixes come after an equal one."""
    hs, ids, sizes = [], [], []
    for h, i, c in zip(*(rows.column(x).to_pylist() for x in ("z", "ids", "counts")), strict=True):
        hs.append(_expand(h, 7))
        sizes.append(len(hs[-1]))
        ids.append(np.repeat(_expand(i, 8).view(np.int64), _expand(c, 4).astype(np.int64)))
    chunk = np.repeat(rows.column("chunk").to_numpy(), sizes)
    h, doc = np.concatenate(hs), np.concatenate(ids)
    del hs, ids
    order = np.lexsort((chunk, doc, h))
    s = h[order]
    later = np.zeros(len(h), bool)
    later[order[1:]] = s[1:] == s[:-1]
    ends = np.cumsum(sizes)
    return pa.table({
        "chunk": rows.column("chunk"), "bucket": rows.column("bucket"),
        "z": pa.array([_bits(later[e - n:e]) for e, n in zip(ends, sizes, strict=True)], pa.binary())})


_ANSWER = "chunk long, bucket long, z binary"


def _by_chunk(answers: DataFrame, name: str) -> DataFrame:
    """One row per chunk: its buckets' answers (a bit per entry it sent)."""
    return answers.groupBy("chunk").agg(F.collect_list(F.struct("bucket", "z")).alias(name))


def _copies(chunks: DataFrame) -> DataFrame:
    """``chunk, skip``: places of documents whose whole text occurs before."""
    docs = chunks.select("chunk", F.posexplode(F.arrays_zip("ids", "digests")).alias("place", "d")).select(
        "chunk", "place", F.col("d.ids").alias("id"), F.col("d.digests").alias("digest"))
    first = docs.groupBy("digest").agg(
        F.min(F.struct("id", "chunk", "place")).alias("f"), F.count(F.lit(1)).alias("c")).where("c > 1")
    return docs.join(first, "digest").where(
        "not (chunk = f.chunk and place = f.place)").groupBy("chunk").agg(
        F.sort_array(F.collect_list("place")).alias("skip"))


def _answers(value) -> dict[int, bytes]:
    return {a["bucket"]: a["z"] for a in value or ()}


def _rows(batches: Iterator[pa.RecordBatch]):
    for batch in batches:
        for i in range(batch.num_rows):
            yield batch.slice(i, 1).to_pylist()[0]


def _send_samples(buckets: int):
    def run(batches):
        for r in _rows(batches):
            s = _Samples(_Chunk(r["lens"], r["z"], r["skip"]), buckets)
            out = [(r["chunk"], b, z) for b, _, z, _ in s.payloads()]
            if out:
                chunk, bucket, z = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int64()), pa.array(z, pa.binary())],
                    ["chunk", "bucket", "z"])

    return run


def _send_suffixes(buckets: int):
    def run(batches):
        for r in _rows(batches):
            c = _Chunk(r["lens"], r["z"], r["skip"])
            s = _Suffixes(c, _Samples(c, buckets).tied(_answers(r["tied"])), buckets)
            out = [(r["chunk"], b, z, i, n) for b, _, z, i, n in
                   s.payloads(np.array(r["ids"], np.int64))]
            if out:
                chunk, bucket, z, ids, counts = zip(*out, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(chunk, pa.int64()), pa.array(bucket, pa.int64()), pa.array(z, pa.binary()),
                     pa.array(ids, pa.binary()), pa.array(counts, pa.binary())],
                    ["chunk", "bucket", "z", "ids", "counts"])

    return run


_RESULT = [("doc_id", pa.int64()), ("n_bytes", pa.int64()), ("n_removed", pa.int64()),
           ("n_spans", pa.int64()), ("kept_sha256", pa.string()),
           ("spans", pa.list_(pa.list_(pa.int64())))]


def _spans(gone: np.ndarray) -> np.ndarray:
    """Maximal runs ``[start, end)`` of bytes covered by repeats starting at ``gone`` (sorted)."""
    if not len(gone):
        return np.zeros((0, 2), np.int64)
    cut = np.flatnonzero(gone[1:] > gone[:-1] + LENGTH)
    starts = np.concatenate([[gone[0]], gone[cut + 1]])
    ends = np.concatenate([gone[cut], [gone[-1]]]) + LENGTH
    return np.stack([starts, ends], 1)


def _finish(buckets: int):
    def run(batches):
        for r in _rows(batches):
            c = _Chunk(r["lens"], r["z"], r["skip"])
            tied = _answers(r["tied"])
            s = _Suffixes(c, _Samples(c, buckets).tied(tied), buckets)
            gone = s.repeats(_answers(r["later"]))
            # Suffixes of one document lie together, so each document's part is a slice.
            edges = np.searchsorted(gone, c.starts)
            out = []
            for d, doc_id in enumerate(r["ids"]):
                a, b = int(c.starts[d]), int(c.starts[d + 1])
                if c.active[d]:
                    spans = _spans(gone[edges[d]:edges[d + 1]]) - a
                elif b - a >= LENGTH:  # a later copy: all its strings start earlier
                    spans = np.array([[0, b - a]])
                else:
                    spans = np.zeros((0, 2), np.int64)
                keep, at = hashlib.sha256(), a
                for lo, hi in (spans + a).tolist():
                    keep.update(c.raw[at:lo])
                    at = hi
                keep.update(c.raw[at:b])
                out.append((None if doc_id == NULL_ID else doc_id, b - a,
                            int((spans[:, 1] - spans[:, 0]).sum()), len(spans), keep.hexdigest(),
                            spans.tolist()))
            cols = zip(*out, strict=True)
            yield pa.RecordBatch.from_arrays(
                [pa.array(v, t) for v, (_, t) in zip(cols, _RESULT, strict=True)],
                [n for n, _ in _RESULT])

    return run


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans`` (byte ranges) per row."""
    spark = docs.sparkSession
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    name = f"suffix_chunks_{uuid.uuid4().hex}"
    # Bucketed by chunk, so the joins with answers below shuffle only the answers.
    (rows.mapInArrow(_pack, _PACKED).repartition(parts, "chunk").write.bucketBy(parts, "chunk")
     .option("compression", "none").option("path", scratch_dir(spark, "chunks")).saveAsTable(name))
    chunks = spark.table(name)
    total = chunks.select(F.sum(F.expr("aggregate(lens, 0L, (a, x) -> a + x)"))).first()[0] or 0
    buckets = max(1, -(-total // BUCKET))
    skips = store(_copies(chunks), "copies")
    base = chunks.drop("digests").join(skips, "chunk", "left")
    sent = base.mapInArrow(_send_samples(buckets), "chunk long, bucket long, z binary")
    tied = store(_by_chunk(sent.groupBy("bucket").applyInArrow(_rank_samples, _ANSWER), "tied"), "tied")
    known = base.join(tied, "chunk", "left")
    sent = known.mapInArrow(
        _send_suffixes(buckets), "chunk long, bucket long, z binary, ids binary, counts binary")
    later = store(_by_chunk(sent.groupBy("bucket").applyInArrow(_sort_suffixes, _ANSWER), "later"),
                  "later")
    return known.join(later, "chunk", "left").mapInArrow(
        _finish(buckets), "doc_id long, n_bytes long, n_removed long, n_spans long, "
                          "kept_sha256 string, spans array<array<long>>")


def op10_suffix_blocks(spark, sf_dir):
    return repeated_spans(read(spark, sf_dir, "documents")).drop("spans")


QUERIES = {"op10_suffix_blocks": op10_suffix_blocks}
ORACLE_SQL: dict[str, str] = {}  # checked by brute force in tests/llm
