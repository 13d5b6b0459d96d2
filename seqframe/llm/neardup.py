"""Near-duplicate documents by MinHash with tensored banding.

A document's set holds its distinct shingles of ``SHINGLE`` words (a parameter).  Two collections of ``T`` sub-keys are
computed, each sub-key from ``R`` minhashes; table keys are all ``T * T`` combinations of a sub-key of
the first collection with one of the second.  So ``T * T`` tables of ``2R`` minhashes each need
``2 * T * R`` minhashes only.  At the threshold 0.8, a sub-key of two agrees with probability 0.64, so a
linked pair shares no table with probability of at most ``2 * 0.36**12`` = 1e-5; above the threshold
this falls quickly (1e-8 at 0.9).

* Texts with equal words form a class; only classes are compared, copies follow their class.
* A combination is formed only from sub-keys that another class shares, so documents without any
  similar partner drop out before the T * T expansion.
* Candidates are confirmed on the full sets, from the words themselves.  Within a table's bucket pairs
  are not listed: each member is compared with the bucket's smallest member (hub), one comparison
  per row however large the bucket.  Buckets whose members are then all in one component need
  nothing more: components, not links, are the result.  Of the other buckets, pairs in different
  components that pass two exact bounds on their overlap are decided by what each member does not have in
  common with the hub, and only linked pairs leave that join (``_open_pairs``).  So every
  pair that shares a bucket is compared, known to be connected, or proved not to be linked.

Null and empty texts (no words) have no set and are linked with nothing.  A null id never
is a component's smallest; rows with a null id and no other member get a null component and are
kept.  Repeated ids form one node per distinct text; equal rows are all kept if their id is the
component's.  Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import DOCUMENT_COLUMNS, read, store
from seqframe.llm.components import components

SHINGLE = 5
PERCENT = 80
T = 12  # sub-keys per collection
R = 2  # minhashes per sub-key
BROADCAST_IDS = 2_000_000
#: Minhashes of a member's difference from its hub, a turn; turns at most.
SUB_KEYS = 4
MAX_TURNS = 12

_UPPER_TO_LOWER = bytes(c + 32 if 65 <= c <= 90 else c for c in range(256))
_RNG = np.random.default_rng(23)
_ODD = lambda n: _RNG.integers(1, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_A, _B = _ODD(2 * T * R), _ODD(2 * T * R)
_PLACE = _ODD(16)
_MIX = _ODD(R)
#: Shingles hashed at once with all functions.
CHUNK = 1 << 14


def words_of(text: bytes | None) -> list[bytes]:
    return (text or b"").translate(_UPPER_TO_LOWER).split()


def shingles(words: list, shingle: int = SHINGLE) -> set[tuple]:
    """Distinct runs of ``shingle`` words; the whole sequence if it is shorter; empty without words."""
    if len(words) < shingle:
        return {tuple(words)} if words else set()
    return set(zip(*(words[k:] for k in range(shingle)), strict=False))


def similar(both: int, a: int, b: int, percent: int = PERCENT) -> bool:
    """Sets of sizes ``a`` and ``b`` with ``both`` in common reach the threshold."""
    return 100 * both >= percent * (a + b - both)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    return x ^ (x >> np.uint64(29))


def sub_keys(hashes: np.ndarray) -> np.ndarray:
    """2T sub-keys (int64) of distinct shingle hashes; equal numbers come from equal places only."""
    low = None
    with np.errstate(over="ignore"):
        for s in range(0, len(hashes), CHUNK):
            part = _mixed(hashes[s:s + CHUNK, None] * _A + _B).min(0)
            low = part if low is None else np.minimum(low, part)
        key = np.arange(1, 2 * T + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
        for r in range(R):
            key = _mixed(key + low[r::R] * _MIX[r])
    return key.view(np.int64)


_SIGNED = pa.schema([("doc_id", pa.int64()), ("_k", pa.binary()), ("n_shingles", pa.int64()),
                     ("subs", pa.list_(pa.int64()))])


def _sign(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    known: dict[bytes, int] = {}

    def word_hash(w: bytes) -> int:
        if (h := known.get(w)) is None:
            h = int.from_bytes(hashlib.blake2b(w, digest_size=8).digest(), "little")
            if len(known) < 500_000:
                known[w] = h
        return h

    for batch in batches:
        keys, sizes, subs = [], [], []
        for text in batch.column("text").to_pylist():
            words = words_of(text)
            if not words:
                keys.append(None), sizes.append(0), subs.append(None)
                continue
            h = np.fromiter(map(word_hash, words), np.uint64, len(words))
            w = min(shingle, len(words))
            with np.errstate(over="ignore"):
                s = h[:len(h) - w + 1] * _PLACE[0]
                for k in range(1, w):
                    s += h[k:len(h) - w + 1 + k] * _PLACE[k]
            s = np.unique(_mixed(s))
            keys.append(hashlib.blake2b(b" ".join(words), digest_size=16).digest())
            sizes.append(len(s)), subs.append(sub_keys(s))
        yield pa.RecordBatch.from_arrays(
            [batch.column("doc_id"), pa.array(keys, pa.binary()), pa.array(sizes, pa.int64()),
             pa.array(subs, pa.list_(pa.int64()))], schema=_SIGNED)


def _normalise(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = [b" ".join(words_of(t)) for t in batch.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [pa.array([hashlib.blake2b(t, digest_size=16).digest() for t in texts], pa.binary()),
             pa.array(texts, pa.binary())], ["k", "words"])


def _confirm(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Full-set comparison of each pair; consecutive rows often share the hub."""
    last, hub = None, set()
    for batch in batches:
        out = []
        for v, words, hub_words in zip(*(batch.column(c).to_pylist() for c in ("v", "w", "hub_w")),
                                       strict=True):
            if v != last:
                last, hub = v, shingles(hub_words.split(b" "), shingle)
            own = shingles(words.split(b" "), shingle)
            both = len(own & hub)
            out.append((both, similar(both, len(own), len(hub))))
        both, linked = zip(*out, strict=True) if out else ((), ())
        yield pa.RecordBatch.from_arrays(
            [batch.column("u"), batch.column("v"), pa.array(both, pa.int64()),
             pa.array(linked, pa.bool_())], ["u", "v", "both", "linked"])


def _hash(shingle: tuple) -> int:
    d = hashlib.blake2b(b" ".join(shingle), digest_size=8).digest()
    return int.from_bytes(d, "little", signed=True)


def _hashes(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of a class's distinct shingles; equal hashes only ever loosen the bound on links."""
    for batch in batches:
        for k, words in zip(batch.column("k").to_pylist(), batch.column("words").to_pylist(),
                            strict=True):
            s = [_hash(x) for x in shingles(words.split(b" "), shingle)]
            yield pa.RecordBatch.from_arrays(
                [pa.array([k] * len(s), pa.binary()), pa.array(s, pa.int64())], ["k", "s"])


def _differences(shingle: int, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Hashes of the shingles that only one of a class and its hub has."""
    last, hub = None, set()
    for batch in batches:
        out = []
        for v, words, hub_words in zip(*(batch.column(c).to_pylist() for c in ("v", "w", "hub_w")),
                                       strict=True):
            if v != last:
                last, hub = v, shingles(hub_words.split(b" "), shingle)
            out.append([_hash(x) for x in shingles(words.split(b" "), shingle) ^ hub])
        yield pa.RecordBatch.from_arrays(
            [batch.column("u"), batch.column("v"), pa.array(out, pa.list_(pa.int64()))],
            ["k", "hub", "apart"])


def _joined(pairs: DataFrame, words: DataFrame) -> DataFrame:
    """``u, v, w, hub_w``: pairs with both sides' words."""
    a = words.select(F.col("k").alias("u"), F.col("words").alias("w"))
    b = words.select(F.col("k").alias("v"), F.col("words").alias("hub_w"))
    return pairs.join(a, "u").join(b, "v").select("u", "v", "w", "hub_w")


def _compare(pairs: DataFrame, words: DataFrame, shingle: int) -> DataFrame:
    """``u, v, both, linked`` of distinct pairs ``u, v``: shared shingles, and the verdict."""
    return _joined(pairs, words).mapInArrow(
        partial(_confirm, shingle), "u binary, v binary, both long, linked boolean")


def _tables(live: DataFrame) -> DataFrame:
    """``t, k, n``: the combined keys of every class with live sub-keys on both sides."""
    return live.select("k", "n", F.explode("a").alias("_a"), "b").select(
        "k", "n", "_a", F.explode("b").alias("_b")).select(F.xxhash64("_a", "_b").alias("t"), "k", "n")


def _links(classes: DataFrame, docs: DataFrame, shingle: int) -> DataFrame | None:
    """Confirmed links ``u, v`` between classes that connect all that belongs together."""
    subs = classes.select("k", "n_shingles", F.posexplode("subs").alias("i", "s"))
    shared = subs.groupBy("s").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("s")
    side = lambda first: F.collect_list(
        F.when(F.col("i") < T if first else F.col("i") >= T, F.col("s")))
    live = store(
        subs.join(shared, "s").groupBy("k").agg(
            F.first("n_shingles").alias("n"), side(True).alias("a"), side(False).alias("b"))
        .where("size(a) > 0 and size(b) > 0"), "live")
    if live.isEmpty():
        return None
    buckets = _tables(live).groupBy("t").agg(
        F.min("k").alias("hub"), F.min_by("n", "k").alias("hub_n"), F.count(F.lit(1)).alias("c")
    ).where("c > 1")
    # Buckets are told apart by their hub only: all pairs of a hub's buckets are settled together.
    members = store(
        _tables(live).join(buckets, "t").select("k", "n", "hub", "hub_n").distinct(), "members")
    needed = store(members.select("k").distinct(), "needed")
    words = _words(docs, classes, needed)
    near = f"100 * least(n, hub_n) >= {PERCENT} * greatest(n, hub_n)"
    first = store(_compare(members.where(f"k <> hub and {near}").select(
        F.col("k").alias("u"), F.col("hub").alias("v")), words, shingle), "compared")
    links = first.where("linked").select("u", "v")
    # What a member shares with each hub it was compared with; a hub shares all with itself.
    met = first.select(F.col("u").alias("k"), F.col("v").alias("hub"), "both").unionByName(
        members.where("k = hub").select("k", "hub", F.col("n").alias("both")))
    # A member's pivot: of the hubs it was compared with, the one with the most links.
    degree = links.groupBy(F.col("v").alias("hub")).agg(F.count(F.lit(1)).alias("_d"))
    pivots = met.join(degree, "hub").groupBy("k").agg(
        F.max(F.struct("_d", "hub")).alias("_p")).select("k", F.col("_p.hub").alias("pivot"))
    pairs = _open_pairs(members, met, pivots, components(links), words, shingle)
    if pairs is None:
        return links
    return store(links.unionByName(
        _compare(pairs, words, shingle).where("linked").select("u", "v")), "links")


def at_least(p: str, q: str, both: str) -> str:
    """SQL of a number of shingles of ``p`` that ``q`` certainly lacks, by what both share with one class.

    Outside that class ``p`` has ``n - both`` shingles, ``q`` likewise, and ``own0`` of those of ``p``
    belong to no other class that was ever open; inside it, the numbers shared differ.  ``own`` counts
    against the classes still open, so some of it may lie inside: it is no summand.
    """
    return (f"greatest({p}.own, greatest({p}.own0, coalesce({p}.n - {p}.{both} - {q}.n + {q}.{both}, 0))"
            f" + greatest(0, coalesce({p}.{both} - {q}.{both}, 0)))")


def _open_pairs(members: DataFrame, met: DataFrame, pivots: DataFrame, labels: DataFrame,
                words: DataFrame, shingle: int) -> DataFrame | None:
    """Linked pairs ``u, v`` of a hub's members that are in different components so far.

    ``members`` has ``k, n, hub``; ``met`` has ``k, hub, both``: the shingles shared with a hub (no
    row if never compared); ``pivots`` has ``k, pivot``: the best-linked of a member's hubs.  What is known of a class is kept in one row a class and meets the rows of its
    hubs only after closed hubs are gone.

    * A class whose shingles occur in no other open class for more than a fifth has no link left.
    * A pair whose sets differ too much by ``at_least`` is not linked.  Copies with edits of their own are
      far apart by this measure when one of them is not linked with the hub.
    * Every member carries its difference from the hub; two differences give the size of the
      members' own difference, ``|dx| + |dy| - 2 |dx & dy|``, without their words.
    * Members of a hub that are near copies of each other are first connected by sub-hubs
      (``_sub_hub_links``), turn after turn while that closes hubs, one comparison a member and key.
      Only what is left then meets in a join within the hub, and only linked pairs leave it.
    """
    rows = store(members.join(labels, F.col("k") == F.col("node"), "left").select(
        "k", "n", "hub", F.coalesce("label", "k").alias("c")), "labelled")
    rows = store(_still_open(rows), "open")
    ever = None
    while True:
        classes = store(rows.groupBy("k").agg(F.first("n").alias("n"), F.first("c").alias("c")), "left")
        size = classes.count()
        if not size:
            return None
        own = words.join(classes.select("k"), "k", "left_semi").mapInArrow(
            partial(_hashes, shingle), "k binary, s long").groupBy("s").agg(
            F.count(F.lit(1)).alias("c"), F.min("k").alias("k")).where("c = 1").groupBy("k").agg(
            F.count(F.lit(1)).alias("own"))
        classes = store(classes.join(own, "k", "left").withColumn(
            "own", F.coalesce("own", F.lit(0))), "classes")
        if ever is None:
            ever = classes.select("k", F.col("own").alias("own0"))
        linkable = classes.where(f"100 * (n - own) >= {PERCENT} * n").select("k")
        rows = store(rows.join(linkable, "k", "left_semi"), "linkable")
        rows = store(_still_open(rows), "open")
        still = rows.select("k").distinct()
        if still.count() > 0.9 * size:
            break
    classes = store(classes.join(still, "k", "left_semi").join(ever, "k").join(
        pivots.select("k", "pivot"), "k", "left"), "classes")
    to = rows.where("k <> hub").select(F.col("k").alias("u"), F.col("hub").alias("v"))
    apart = _joined(to, words).mapInArrow(
        partial(_differences, shingle), "k binary, hub binary, apart array<long>")
    rows = rows.join(classes.select("k", "own", "own0", "pivot"), "k").join(
        met, ["k", "hub"], "left").join(apart, ["k", "hub"], "left")
    rows = store(rows.withColumn(  # a hub does not differ from itself
        "apart", F.coalesce("apart", F.expr("cast(array() as array<bigint>)"))), "open")
    found = None
    for turn in range(MAX_TURNS):
        size = rows.count()
        new = store(_sub_hub_links(rows, turn), "sub")
        if new.isEmpty():
            break
        pairs = new.select("u", "v")
        found = pairs if found is None else found.unionByName(pairs)
        merged = components(new.select(F.col("cu").alias("u"), F.col("cv").alias("v")))
        rows = rows.join(merged, F.col("c") == F.col("node"), "left").withColumn(
            "c", F.coalesce("label", "c")).drop("node", "label")
        rows = store(_still_open(rows), "open")
        if rows.count() > 0.9 * size:
            break
    # Members of one pivot meet there only, whatever number of hubs they share.
    rows = rows.where("k <> hub")
    rest = rows.alias("x").join(rows.alias("y"), F.expr(
        "x.hub = y.hub and x.c <> y.c and not x.settled and (x.k < y.k or y.settled) "
        "and (x.pivot is null or x.pivot = x.hub or not (x.pivot <=> y.pivot)) "
        f"and 100 * (x.n - {at_least('x', 'y', 'both')}) >= "
        f"{PERCENT} * (x.n + {at_least('y', 'x', 'both')}) and {_linked('x', 'y')}")).select(
        F.least("x.k", "y.k").alias("u"), F.greatest("x.k", "y.k").alias("v")).distinct()
    return rest if found is None else rest.unionByName(found).distinct()


def _linked(x: str, y: str) -> str:
    """SQL: two members of one hub are linked, by their sizes and their differences from it."""
    return (f"{100 - PERCENT} * ({x}.n + {y}.n) >= {100 + PERCENT} * "
            f"(size({x}.apart) + size({y}.apart) - 2 * size(array_intersect({x}.apart, {y}.apart)))")


def _sub_hub_links(rows: DataFrame, turn: int) -> DataFrame:
    """Links ``u, v, cu, cv`` between components, one comparison a row and key: members of a hub are dealt
    by minhashes of their difference from it, and compared with the smallest member dealt alike."""
    def key(r: int) -> Column:
        return F.array_min(F.transform("apart", lambda a: F.xxhash64(a, F.lit(turn * SUB_KEYS + r))))

    dealt = rows.where("k <> hub and size(apart) > 0").select(
        "hub", "k", "n", "c", "apart", F.posexplode(F.array(*map(key, range(SUB_KEYS)))).alias("r", "m"))
    first = dealt.groupBy("hub", "r", "m").agg(F.min("k").alias("k"), F.count(F.lit(1)).alias("_many")).where(
        "_many > 1").drop("_many").join(rows.select("hub", "k", "n", "c", "apart"), ["hub", "k"])
    return dealt.alias("x").join(first.alias("y"), F.expr(
        f"x.hub = y.hub and x.r = y.r and x.m = y.m and x.c <> y.c and {_linked('x', 'y')}")).select(
        F.col("x.k").alias("u"), F.col("y.k").alias("v"), F.col("x.c").alias("cu"), F.col("y.c").alias("cv")
    ).dropDuplicates(["u", "v"])


def _still_open(rows: DataFrame) -> DataFrame:
    """Members of hubs whose members are in several components.  ``settled`` members are in their hub's
    own component, so a pair of two settled members needs no comparison."""
    hubs = rows.groupBy("hub").agg(F.min("c").alias("_x"), F.max("c").alias("_y"),
                                   F.max(F.when(F.col("k") == F.col("hub"), F.col("c"))).alias("_h"))
    return rows.drop("settled").join(hubs.where("_x <> _y"), "hub").withColumn(
        "settled", F.coalesce(F.col("c") == F.col("_h"), F.lit(False))).drop("_x", "_y", "_h")


def _words(docs: DataFrame, classes: DataFrame, needed: DataFrame) -> DataFrame:
    """``k, words`` of the needed classes, from one document of each."""
    ids = store(classes.join(needed, "k").select(F.col("rep").alias("_id")).distinct(), "ids")
    ids = F.broadcast(ids) if ids.count() <= BROADCAST_IDS else ids
    texts = docs.select(F.col("doc_id").cast("long").alias("_d"),
                        F.col("text").cast("binary").alias("text"))
    found = texts.join(ids, F.col("_d").eqNullSafe(F.col("_id")), "left_semi").select("text")
    # Rows of one id with another text have another key; equal texts are reduced to one.
    return store(
        found.mapInArrow(_normalise, "k binary, words binary").join(needed, "k", "left_semi")
        .groupBy("k").agg(F.first("words").alias("words")), "words")


def near_duplicates(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept, class_id`` per row (class: equal words)."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"),
                       F.col("text").cast("binary").alias("text"))
    signed = store(rows.mapInArrow(
        partial(_sign, shingle), "doc_id long, _k binary, n_shingles long, subs array<long>"), "signed")
    classes = store(
        signed.where("_k is not null").groupBy(F.col("_k").alias("k")).agg(
            F.min("doc_id").alias("rep"), F.first("n_shingles").alias("n_shingles"),
            F.first("subs").alias("subs")), "classes")
    links = _links(classes, docs, shingle)
    reps = classes.select("k", "rep")
    if links is None:
        comps = reps.withColumnRenamed("rep", "component")
    else:
        labelled = reps.join(components(links), F.col("k") == F.col("node"), "left").select(
            "k", "rep", F.coalesce("label", "k").alias("label"))
        lowest = labelled.groupBy("label").agg(F.min("rep").alias("component"))
        comps = labelled.join(lowest, "label").select("k", "component")
    # Rows without words have no class; each joins under a key of its own.
    own = F.coalesce("_k", F.concat(F.lit("-").cast("binary"),
                                    F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")))
    out = signed.select("doc_id", "n_shingles", "_k", own.alias("_j")).join(
        comps.withColumnRenamed("k", "_j"), "_j", "left")
    component = F.when(F.col("_k").isNull(), F.col("doc_id")).otherwise(F.col("component"))
    return out.select(
        "doc_id", "n_shingles", component.alias("component_id"),
        F.col("doc_id").eqNullSafe(component).alias("kept"), F.hex("_k").alias("class_id"))


def filter_documents(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """One document of each group (columns of ``documents``)."""
    rows = docs.select(*DOCUMENT_COLUMNS)
    kept = store(near_duplicates(rows, shingle).where("kept").select(F.col("doc_id").alias("_id")).distinct(),
                 "kept")
    return rows.join(kept, F.col("doc_id").eqNullSafe(F.col("_id")), "left_semi")


def op4_tensored_minhash(spark, sf_dir):
    return near_duplicates(read(spark, sf_dir, "documents"), shingle=4).drop("class_id")


QUERIES = {"op4_tensored_minhash": op4_tensored_minhash}
ORACLE_SQL: dict[str, str] = {}  # checked against all pairs in tests/llm
