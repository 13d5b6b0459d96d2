"""Shards and slots against the permutation written out in plain Python."""

import math
import struct
import zlib

import pytest
import xxhash

from seqframe.llm import sharding

SLICES = 256


def hash64(*values, seed=42):
    """Signed 64-bit hash of integers, one after the other; null leaves it as it is."""
    for v in values:
        if v is not None:
            seed = xxhash.xxh64_intdigest(struct.pack("<q", v), seed)
    return seed - (1 << 64) if seed >> 63 else seed


def permuted(x, n, seed):
    a = math.isqrt(max(0, n - 1)) + 1
    b = max(1, -(-n // a))
    while True:
        left, right = x % a, x // a
        for j in range(sharding.ROUNDS):
            m = b if j % 2 else a
            left, right = right, (left + hash64(right, seed * 31 + j) % m) % m
        x = right * a + left
        if x < n:
            return x


def placed(rows, shards, seed):
    """``(doc_id, size, crc, shard, slot)`` of (doc_id, text) rows."""
    keys = []
    for doc_id, text in rows:
        raw = (text or "").encode()
        keys.append((doc_id, None if text is None else zlib.crc32(raw), len(raw) + 1))
    first_null = lambda v: (v is not None, v or 0)
    keys.sort(key=lambda k: (hash64(*k) % SLICES, *map(first_null, k)))
    out = []
    for i, (doc_id, crc, size) in enumerate(keys):
        p = permuted(i, len(keys), seed)
        out.append((doc_id, size, crc, p % shards, p // shards))
    return out


@pytest.mark.parametrize("n", [1, 2, 3, 7, 50, 101, 1000])
def test_permutation_is_the_plain_one(spark, n):
    df = sharding.permute(spark.range(n).withColumnRenamed("id", "x"), "x", n, 5)
    got = {r["x"]: r["_p"] for r in df.collect()}
    assert got == {x: permuted(x, n, 5) for x in range(n)}
    assert sorted(got.values()) == list(range(n))


@pytest.mark.parametrize("shards", [1, 3, 8])
def test_shards_match_the_plain_version(docs, shards):
    rows = [(i, f"text {i % 40} é") for i in range(300)]
    rows += [(7, "text 7 é")] * 5 + [(None, "x"), (None, None), (3, None), (4, ""), (9, "long " * 50_000)]
    got = sharding.shard(docs(rows, extra=True), shards, 11).collect()
    key = lambda r: tuple((v is not None, v or 0) for v in r)
    plain = [(r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in got]
    assert sorted(plain, key=key) == sorted(placed(rows, shards, 11), key=key)
    assert {(r["law"], r["grown_shard"]) for r in got} == {("rows", None)}
