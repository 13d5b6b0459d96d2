"""Each training-data operator against brute force or an exact round trip, with edge rows."""

import base64
import hashlib
import itertools
import random
import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from seqframe.llm import (
    decontam,
    knnquality,
    licenses,
    mixing,
    neardup,
    quality,
    sharding,
    suffixdedup,
    urlfilters,
    warc,
)
from seqframe.session import scratch_dir

WORDS = [f"w{i}" for i in range(400)]


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


def edge_rows():
    """Null, empty and blank texts, repeated rows, a null id and source, a very long text."""
    rng = random.Random(1)
    return [(1, None), (2, ""), (3, " \t\n "), (4, prose(rng, 40)), (4, prose(rng, 40)), (5, "one two"),
            (None, prose(rng, 30)), (6, prose(rng, 30), None), (7, "é😀ß " * 40), (8, prose(rng, 30_000)),
            (9, "tie tie"), (10, "tie tie"), (5, "one two")]


def by_id(df):
    return {r["doc_id"]: r for r in df.collect()}


# ---------------------------------------------------------------- sharding

@pytest.mark.parametrize("n", [1, 2, 7, 100, 1009])
def test_permutation_is_a_bijection(spark, n):
    df = sharding.permute(spark.range(n).withColumnRenamed("id", "x"), "x", n)
    got = [r["_p"] for r in df.orderBy("x").collect()]
    assert sorted(got) == list(range(n))
    assert n < 50 or got != list(range(n))


def test_shards_are_even_and_gapless(docs):
    rows = edge_rows() + [(i, f"t{i}") for i in range(100, 200)]
    out = sharding.shard(docs(rows, extra=True)).collect()
    assert len(out) == len(rows)
    slots = {}
    for r in out:
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert set(slots) <= set(range(8))
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    assert max(map(len, slots.values())) - min(map(len, slots.values())) <= 1
    texts = {}
    for r in rows:
        texts.setdefault(r[0], set()).add(r[1])
    for r in out:
        assert (r["size"], r["text_crc32"]) in {
            (len((t or "").encode()) + 1, None if t is None else zlib.crc32(t.encode()))
            for t in texts[r["doc_id"]]}
    assert sharding.shard(docs([])).count() == 0


# ------------------------------------------------------------------ mixing

def test_mix_meets_targets_exactly(docs):
    rng = random.Random(2)
    rows = [(i, prose(rng, rng.randint(1, 60)), rng.choice(["a", "b", "c", None, "hot", "hot", "hot"]))
            for i in range(300)] + edge_rows()
    out = mixing.mix(docs(rows, extra=True), carry=["source"]).collect()
    assert len(out) == len(rows)
    by = {}
    for r in out:
        assert 0 <= r["taken"] <= 3 * r["size"]
        by.setdefault(r["source"], []).append(r)
    total = sum(r["size"] for r in out)
    names = sorted((s for s in by if s is not None)) + [None]
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    # Water-filling by its definition: cap, reshare, repeat.
    size = {s: sum(r["size"] for r in by[s]) for s in names}
    capped = set()
    while True:
        level = (total - sum(3 * size[s] for s in capped)) / max(
            1e-9, sum(weight[s] for s in names if s not in capped))
        over = {s for s in names if s not in capped and level * weight[s] >= 3 * size[s]}
        if not over:
            break
        capped |= over
    for s in names:
        target = 3 * size[s] if s in capped else level * weight[s]
        assert all(abs(r["target"] - target) < 1e-6 for r in by[s])
        assert sum(r["taken"] for r in by[s]) == int(target + 1e-9)
        partial = [r for r in by[s] if r["size"] and r["taken"] % r["size"]]
        assert len(partial) <= 1
    again = mixing.mix(docs(rows[::-1])).collect()
    assert sorted((str(r["doc_id"]), r["taken"]) for r in out) == sorted(
        (str(r["doc_id"]), r["taken"]) for r in again)


def test_applied_mix_has_the_words_taken(docs):
    rng = random.Random(3)
    rows = [(i, prose(rng, rng.randint(1, 30)).replace(" ", " \n", 1), rng.choice("ab")) for i in range(80)]
    taken = {r["doc_id"]: r["taken"] for r in mixing.mix(docs(rows)).collect()}
    out = {}
    for r in mixing.apply_mix(docs(rows)).collect():
        assert dict(map(lambda x: (x[0], x[1]), rows))[r["doc_id"]].startswith(r["text"])
        assert r["n_chars"] == len(r["text"])
        out[r["doc_id"]] = out.get(r["doc_id"], 0) + len(r["text"].split())
    assert out == {k: v for k, v in taken.items() if v}
    assert mixing.apply_mix(docs([])).count() == 0


# ---------------------------------------------------------------- licenses

def brute_labels(text):
    import re
    n = re.sub(licenses.NON_WORD, " ", (text or "").translate(
        str.maketrans(licenses.UPPER, licenses.LOWER))).strip(" ")
    words = n.split(" ") if n else []
    found = []
    for i, r in enumerate(licenses.RULES):
        for m in re.finditer(rf"(?<![^ ])(?:{r.pattern})(?![^ ])", n):
            a = n[:m.start()].count(" ")
            found.append((a, a + m.group().count(" "), r.tier, i, r.label, r.base))
    kept, base = set(), sorted({d[4] for d in found if d[5]})
    for d in found:
        if not any(e != d and e[2] <= d[2] and e[0] <= d[0] and e[1] >= d[1]
                   and (e[:3] != d[:3] or e[3] < d[3])
                   and (e[2] < d[2] or e[:2] != d[:2] or e[3] < d[3]) for e in found):
            kept.add(d[4])
    at = [d[0] for d in found if d[5]]
    return (len(words), len(at), min(at, default=None), max(at, default=None), ",".join(base),
            ",".join(sorted(kept | set(base))))


def test_licenses_match_brute_force(docs):
    texts = [
        "Released under the MIT License.", "Licensed under the Apache License, Version 2.0.",
        "This work is licensed under the GNU General Public License, version 3.",
        "Licensed under CC BY-NC 4.0.", "SPDX-License-Identifier: Apache-2.0", "the mit  license mit license",
        "Permit License", "Copyright (c) 2020 X. All rights reserved.", "GNU LESSER GENERAL PUBLIC LICENSE 2.1",
        "no words here", "licensed under something", "mit license " * 500, "ÉMIT license", "mit\nlicense",
        "Apache License or MIT License, dedicated to the public domain", None, "", "???"]
    out = by_id(licenses.scan(docs(list(enumerate(texts)), extra=True)))
    for i, t in enumerate(texts):
        r = out[i]
        got = tuple(r[c] for c in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels"))
        assert got == brute_labels(t), t
        assert 0 <= r["score"] <= 1
    assert out[1]["labels"] == "apache,apache-2.0" and out[3]["labels"] == "cc-by-nc-4.0"
    assert licenses.scan(docs([])).count() == 0
    assert len(licenses.RULES) > 200


# ----------------------------------------------------------------- quality

def brute_quality(text):
    b = (text or "").encode()
    words = b.split()
    runs = [tuple(words[i:i + 8]) for i in range(len(words) - 7)]
    cover = {i + k for i, r in enumerate(runs) if runs.count(r) > 1 for k in range(8)}
    seen, dup = set(), 0
    for line in b.split(b"\n"):
        if line.split():
            dup += line in seen
            seen.add(line)
    return (len(words), sum(len(w.decode()) for w in words), sum(b.count(c) for c in b"#*$%&|<>"), dup,
            len(cover))


def test_quality_figures_and_frequent_lines(docs):
    rng = random.Random(4)
    line = prose(rng, 12)
    rows = [(i, prose(rng, 40) + "\n" + line + f"\n{i} x # |", "hot") for i in range(40)]
    rows += [(100, line + "\n" + line, "hot"), (101, line + "\n" + prose(rng, 30), "other"),
             (102, "a b c d e f g h " * 9), (103, "é x\n\x0by\ny\ny " * 5)]
    rows += [r for r in edge_rows() if r[0] not in (8,)]
    out = quality.judge(docs(rows, extra=True)).collect()
    assert len(out) == len(rows)
    want = {}
    for r in rows:
        want.setdefault(r[0], set()).add(brute_quality(r[1]))
    for r in out:
        got = tuple(r[c] for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"))
        assert got in want[r["doc_id"]], r["doc_id"]
        assert r["base_failed"] == (got[0] < 20 or 100 * got[4] > 30 * got[0])
    by = {r["doc_id"]: r for r in out}
    assert by[20]["n_removed_words"] == 16 and by[20]["kept"]  # digits count as 0 in "20 x # |"
    assert not by[100]["kept"]  # nothing but the frequent line
    assert by[101]["n_removed_words"] == 0  # another host
    texts = by_id(quality.filter_documents(docs(rows)))
    assert line not in texts[20]["text"] and texts[20]["n_chars"] == len(texts[20]["text"])
    assert line in texts[101]["text"] and 100 not in texts
    assert quality.judge(docs([])).count() == 0


@given(st.lists(st.sampled_from([b"a", b"b", b"c"]), max_size=60))
@settings(max_examples=60, deadline=None)
def test_repeated_words(words):
    assert quality.repeated_words(words) == brute_quality(b" ".join(words).decode())[4]


# ----------------------------------------------------------------- neardup

def brute_components(rows, shingle=5):
    sets = [neardup.shingles(neardup.words_of((t or "").encode()), shingle) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * (len(sets[i]) + len(sets[j]) - both):
                root[find(i)] = find(j)
    low = {}
    for i, (d, _) in enumerate(rows):
        if d is not None:
            low[find(i)] = min(d, low.get(find(i), d))
    return [(len(s), low.get(find(i))) for i, s in enumerate(sets)]


@pytest.mark.parametrize("shingle", [4, 5])
def test_near_duplicates_match_all_pairs(docs, shingle):
    rng = random.Random(5)
    rows, n = [], 0
    common = prose(rng, 60).split()
    for _ in range(6):  # groups of copies with edits of their own, around the threshold
        base = prose(rng, 110).split()
        for _ in range(25):
            words = list(base)
            for _ in range(rng.randint(0, 7)):
                words[rng.randrange(len(words))] = f"edit{rng.randint(0, 10**6)}"
            rows.append((n, " ".join(words)))
            n += 1
    for _ in range(60):  # a passage that many different documents share
        rows.append((n, " ".join(prose(rng, 40).split() + common)))
        n += 1
    chain = prose(rng, 100).split()
    for i in range(12):  # each linked with the next only
        chain[i * 8:i * 8 + 2] = [f"c{i}", f"d{i}"]
        rows.append((n, " ".join(chain)))
        n += 1
    rows += [(n + i, r[1]) for i, r in enumerate(edge_rows()) if r[0] != 8]
    rows += [(n + 50, rows[0][1].upper()), (n + 51, "a b c"), (n + 52, "A  B c"), (None, rows[0][1])]
    out = {}
    for r in neardup.near_duplicates(docs(rows, extra=True), shingle).collect():
        out.setdefault(r["doc_id"], []).append(r)
    for (d, _), (size, comp) in zip(rows, brute_components(rows, shingle), strict=True):
        r = out[d][0]
        assert (r["n_shingles"], r["component_id"]) == (size, comp), d
        assert r["kept"] == (d == comp)
    kept = neardup.filter_documents(docs(rows), shingle).count()
    assert kept == sum(r["kept"] for rs in out.values() for r in rs)
    assert neardup.near_duplicates(docs([])).count() == 0


# ---------------------------------------------------------------- decontam

def brute_leak(text, items):
    words = decontam.words_of((text or "").encode())
    hits = []
    for item, t in items:
        w = decontam.words_of((t or "").encode())
        k = min(12, len(w))
        for shift in range(-len(w) + k, len(words) - k + 1):
            same = [0 <= shift + q < len(words) and words[shift + q] == w[q] for q in range(len(w))]
            inside = [q for q in range(len(w)) if 0 <= shift + q < len(words)]
            if k and any(sum(same[q:q + k]) >= 0.8 * k for q in inside if q + k - 1 in inside):
                hits.append(item)
                break
    return hits


def test_leaks_match_brute_force(spark, docs):
    rng = random.Random(6)
    items = [(i, prose(rng, rng.choice([3, 6, 14, 30, 45]))) for i in range(20)]
    items += [(30, None), (31, "")]
    rows = [(i, prose(rng, 80)) for i in range(30)]
    for i in range(30, 60):
        words = items[i % 20][1].split()
        if len(words) > 12:  # one word in eight replaced
            words = [f"new{q}" if q % 8 == 3 else w for q, w in enumerate(words)]
        rows.append((i, prose(rng, 20) + " " + " ".join(words).upper() + ", " + prose(rng, 5)))
    rows += [(61, None), (62, ""), (63, "..."), (64, items[4][1])]
    bench = spark.createDataFrame(items, "item_id long, text string")
    whole = by_id(decontam.find_leaks(docs(rows, extra=True), bench))
    for d, t in rows:
        hits = brute_leak(t, items)
        assert whole[d]["contaminated"] == bool(hits) and whole[d]["n_items"] == len(hits), d
    parts = by_id(decontam.find_leaks(docs(rows), bench, block_bytes=2000))  # several blocks, same verdicts
    assert all(parts[d] == whole[d] for d, _ in rows)
    left = decontam.filter_documents(docs(rows), bench)
    assert left.count() == sum(not r["contaminated"] for r in whole.values())
    assert decontam.find_leaks(docs([]), bench).count() == 0
    assert not any(r["contaminated"] for r in decontam.find_leaks(docs(rows), bench.limit(0)).collect())


@pytest.mark.parametrize("n", range(1, 16))
def test_no_allowed_substitution_is_lost(n):
    """Every set of up to three substituted words: found exactly when verification accepts it."""
    item = [f"w{k}" for k in range(n)]
    index = decontam.build_index([(1, " ".join(item))])
    for size in range(min(3, n) + 1):
        for gone in itertools.combinations(range(n), size):
            text = "other words " + " ".join("x" if k in gone else w for k, w in enumerate(item)) + " end"
            want = bool(brute_leak(text, [(1, " ".join(item))]))
            assert bool(decontam._judge(index, [text.encode()])[0]) == want, gone


def test_items_without_an_id(spark, docs):
    rng = random.Random(8)
    texts = [prose(rng, 30) for _ in range(6)]
    bench = spark.createDataFrame(
        [(None, texts[0]), (None, texts[1]), (7, texts[2]), (7, texts[3]), (9, texts[3])],
        "item_id long, text string")
    rows = [(0, texts[0]), (0, texts[0]), (1, f"{texts[0]} and {texts[1]}"), (2, f"{texts[2]} {texts[3]}"),
            (3, texts[4]), (None, texts[1]), (4, f"{texts[0]} {texts[3]}")]
    want = [(0, 1, None), (0, 1, None), (1, 2, None), (2, 2, 7), (3, 0, None), (None, 1, None), (4, 3, 7)]
    for size in (decontam.BLOCK_BYTES, 200):
        got = decontam.find_leaks(docs(rows), bench, block_bytes=size).collect()
        assert sorted(((r["doc_id"], r["n_items"], r["item_id"]) for r in got if r["doc_id"] is not None),
                      key=str) == sorted((w for w in want if w[0] is not None), key=str)
        assert [(r["n_items"], r["item_id"]) for r in got if r["doc_id"] is None] == [(1, None)]


# --------------------------------------------------------------- suffixes

def test_repeated_spans_match_brute_force(docs):
    rng = random.Random(7)
    shared = [prose(rng, 40) for _ in range(5)]
    rows = []
    for i in range(60):
        parts = [prose(rng, rng.randint(0, 30)), rng.choice(shared)[rng.randint(0, 60):], prose(rng, 5)]
        rows.append((i * 3 % 60, " ".join(parts)))
    rows += [(70, "ab" * 200), (71, "é" * 120), (72, None), (73, ""), (74, rows[0][1]), (75, rows[0][1]),
             (76, "x" * 99), (77, "x" * 99), (78, rows[1][1][:150] + rows[2][1])]
    rows = list({r[0]: r for r in rows}.values())
    out = by_id(suffixdedup.repeated_spans(docs(rows[::-1], extra=True)))
    seen = set()
    for d, t in sorted(rows):
        b = (t or "").encode()
        gone = bytearray(len(b))
        for p in range(len(b) - 99):
            if b[p:p + 100] in seen:
                gone[p:p + 100] = b"\1" * 100
            seen.add(b[p:p + 100])
        kept = bytes(c for c, g in zip(b, gone, strict=True) if not g)
        runs = bytes(gone).replace(b"\0", b" ").split()
        r = out[d]
        assert (r["n_bytes"], r["n_removed"], r["n_spans"], r["kept_sha256"]) == (
            len(b), sum(gone), len(runs), hashlib.sha256(kept).hexdigest()), d
        assert [e - s for s, e in r["spans"]] == [len(x) for x in runs]
    assert suffixdedup.repeated_spans(docs([])).count() == 0
    assert suffixdedup.repeated_spans(docs(edge_rows())).count() == len(edge_rows())


def test_cover_and_hashes():
    assert {(a - b) % 31 for a in suffixdedup.COVER for b in suffixdedup.COVER} == set(range(31))
    data = np.frombuffer(random.Random(8).randbytes(200_000), np.uint8)
    at = np.array([0, 5, 65_500, 65_536, 131_000, 199_900])
    twice = np.concatenate([data, data])
    a = suffixdedup.prefix_hashes(twice, at, 100)
    b = suffixdedup.prefix_hashes(twice, at + 200_000, 100)
    assert (a[:-1] == b[:-1]).all() and len(set(a.tolist())) == len(at)


# -------------------------------------------------------------------- warc

def test_warc_round_trip_and_lookup(spark):
    rows = [(i, f"https://Sub.Host{i % 3}.Example.org/p/{i % 7}?q={i % 2}", f"<p>{i % 11} é</p>" * (i % 5))
            for i in range(60)]
    rows += [(60, None, None), (61, "", ""), (62, "x\ty z\n", "<p>\r\n\r\n</p>"), (63, rows[5][1], rows[5][2])]
    pages = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as `key`")
    folder = scratch_dir(spark, "warc-test")
    captures = warc.write_archive(pages, f"{folder}/a")
    directory = warc.write_index(captures, f"{folder}/i")
    found = warc.lookup(warc.keys_of(pages), directory, f"{folder}/i")
    out = {r["page_id"]: r for r in warc.read_records(found, f"{folder}/a").collect()}
    best = {}
    for i, _, h in rows:
        best[h or ""] = max(i, best.get(h or "", 0))
    assert len(out) == len(rows)
    for i, _, h in rows:
        b, last = (h or "").encode(), best[h or ""]
        assert tuple(out[i])[1:] == (
            len(b), base64.b32encode(hashlib.sha1(b).digest()).decode(),
            "response" if i == last else "revisit", None if i == last else last)
    one = spark.createDataFrame([(warc.surt(rows[5][1]),), ("org,none)/",)], "key string")
    want = sorted(i for i, u, _ in rows if warc.surt(u) == warc.surt(rows[5][1]))
    assert sorted(r["page_id"] for r in warc.lookup(one, directory, f"{folder}/i").collect()) == want


def test_warc_of_no_pages(spark):
    pages = spark.createDataFrame([], "page_id long, url string, html string")
    folder = scratch_dir(spark, "warc-empty")
    directory = warc.write_index(warc.write_archive(pages, f"{folder}/a"), f"{folder}/i")
    assert warc.lookup(warc.keys_of(pages), directory, f"{folder}/i").count() == 0


# --------------------------------------------------------------------- url

def test_url_verdict_is_as_of_the_day(spark):
    events = spark.createDataFrame([
        ("bad.org", "block", 10, True), ("bad.org", "block", 40, False), ("bad.org", "block", 200, True),
        ("bad.org/ok", "allow", 0, True), ("x.bad.org", "block", 5, True), ("x.bad.org", "block", 5, False),
        (None, "block", 0, True)], "entry string, list string, day int, added boolean")
    caps = [(0, "http://bad.org/a", 9), (1, "http://bad.org/a", 10), (2, "http://A.bad.org:80/a", 39),
            (3, "http://bad.org", 40), (4, "http://u@bad.org./z", 300), (5, "http://bad.org/ok/1", 20),
            (6, None, 20), (7, "nonsense", 20), (8, "http://notbad.org/", 20), (9, "http://bad.org/a", None),
            (1, "http://bad.org/a", 10), (10, "http://x.bad.org/", 6)]
    df = spark.createDataFrame(caps, "page_id long, url string, day int").selectExpr("*", "1 as host")
    out = urlfilters.evaluate(df, events, ["page_id"]).collect()
    assert len(out) == len(caps)
    assert {r["page_id"] for r in out if r["blocked"]} == {1, 2, 4}
    assert {r["matched"] for r in out} == {None, "bad.org"}
    assert urlfilters.evaluate(df.limit(0), events, ["page_id"]).count() == 0
    assert not any(r["blocked"] for r in urlfilters.evaluate(df, events.limit(0), ["page_id"]).collect())


# ---------------------------------------------------------------- classifier

def test_classifier_held_out_accuracy(spark, docs):
    sf = "/root/testdata/sf0.01"
    labels = spark.read.parquet(f"{sf}/labels.parquet")
    out = knnquality.score(spark.read.parquet(f"{sf}/documents.parquet"), labels)
    held = out.join(labels, "doc_id").where("held_out").select("predicted", "quality").collect()
    good = [r["predicted"] for r in held if r["quality"] == 1]
    assert sum(good) / len(good) > 0.95
    assert sum(r["predicted"] == r["quality"] for r in held) / len(held) > 0.93
    rows = edge_rows()
    edge = knnquality.score(docs(rows, extra=True), labels).collect()
    assert len(edge) == len(rows) and all(0 <= r["score"] <= 1 for r in edge)
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 5 == 0)
               for r in edge if r["doc_id"] is not None)
    none = knnquality.score(docs([(1, "text"), (2, "")]), labels.limit(0)).collect()
    assert [r["score"] for r in sorted(none)] == [0.5, 0.0]
    assert knnquality.score(docs([]), labels).count() == 0
