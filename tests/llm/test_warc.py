"""Capture index: keys with ports, several shards and blocks a key, null and repeated page ids."""

import base64
import hashlib

import pytest

from seqframe.llm import warc
from seqframe.session import scratch_dir

PAGES = "page_id long, url string, html string"


@pytest.mark.parametrize("url, key", [
    ("https://Blog.Example.org/a?b", "org,example,blog)/a?b"),
    ("http://a.example.org:8080/x", "org,example,a:8080)/x"),
    ("http://a.example.org:80/x", "org,example,a)/x"),
    ("https://a.example.org:443", "org,example,a)/"),
    ("https://a.example.org:80/", "org,example,a:80)/"),
    ("http://user:pw@a.example.org.:81/x#y", "org,example,a:81)/x"),
    ("http://[::1]:8080/x", "[::1]:8080)/x"),
    ("http://[::1]/x", "[::1])/x"),
    ("a.org:/x", "org,a)/x"),
    ("a.org", "org,a)/"),
    ("", ")/"),
    (None, ")/"),
])
def test_keys(url, key):
    assert warc.surt(url) == key


def test_one_host_is_adjacent_whatever_its_port():
    keys = sorted(map(warc.surt, ["http://a.org:8080/x", "http://a.org/x", "http://b.org/", "http://a.org:81/"]))
    assert [k.split(")")[0].split(":")[0] for k in keys] == ["org,a", "org,a", "org,a", "org,b"]


def built(spark, pages):
    folder = scratch_dir(spark, "warc-test")
    captures = warc.write_archive(pages, f"{folder}/a")
    return folder, captures, warc.write_index(captures, f"{folder}/i")


@pytest.mark.parametrize("partitions, shard_rows", [(1, 1 << 19), (3, 70), (8, 7)])
def test_lookup_is_the_join_on_the_key(spark, monkeypatch, partitions, shard_rows):
    """Few and many shards, blocks of four lines, a key of hundreds of captures, unknown and odd keys."""
    monkeypatch.setattr(warc, "BLOCK", 4)
    monkeypatch.setattr(warc, "ANSWERS", 10)
    monkeypatch.setattr(warc, "FILE_BYTES", 200)  # index and archive files roll over within a shard
    monkeypatch.setattr(warc, "SHARD_ROWS", shard_rows)
    rows = [(i, f"http://h{i % 9}.org:{80 + i % 3}/{i % 40}", f"p{i}") for i in range(200)]
    rows += [(1000 + i, "http://hot.org/", f"h{i % 50}") for i in range(300)]
    rows += [(2000, "a\tz", ""), (2001, "a b", "x"), (2002, "a\nb", "y"), (2003, None, None)]
    old = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", partitions)
    try:
        folder, captures, directory = built(spark, spark.createDataFrame(rows, PAGES))
        assert directory.select("shard").distinct().count() <= max(partitions, -(-len(rows) // shard_rows))
        asked = [warc.surt(u) for _, u, _ in rows[::3]] + ["zz)/", "", "org,h1)/none", "org,hot)/"]
        asked += [warc.surt(u) for _, u, _ in rows[-4:]]
        keys = spark.createDataFrame([(k,) for k in asked], "key string")
        got = sorted((r["key"], r["page_id"]) for r in warc.lookup(keys, directory, f"{folder}/i").collect())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", old)
    plain = [(warc.surt(u).replace("\t", " ").replace("\n", " "), i) for i, u, _ in rows]
    wanted = {k.replace("\t", " ").replace("\n", " ") for k in asked}
    assert got == sorted(p for p in plain if p[0] in wanted)


def test_null_and_repeated_ids_and_a_long_page(spark):
    long = "<p>long é</p>" * 200_000
    rows = [(None, "http://a.org/1", "same"), (-1, "http://a.org/2", "same"), (5, "http://a.org/3", "same"),
            (None, "http://a.org/4", "alone"), (None, "http://a.org/5", "alone"), (7, "http://a.org/6", "x"),
            (7, "http://a.org/7", "y"), (7, "http://a.org/8", "x"), (8, "http://a.org/9", long),
            (9, "http://a.org/10", long), (10, None, None), (11, None, "")]
    pages = spark.createDataFrame(rows, PAGES).selectExpr(
        "*", "1 as key", "2 as file", "3 as offset", "4 as _p", "5 as print", "6 as best")
    folder, captures, directory = built(spark, pages)
    found = warc.lookup(warc.keys_of(pages), directory, f"{folder}/i")
    out = sorted((tuple(r) for r in warc.read_records(found, f"{folder}/a").collect()), key=repr)

    def want(i, html):
        raw = (html or "").encode()
        ids = [j for j, _, h in rows if (h or "") == (html or "") and j is not None]
        best = max(ids, default=None)
        kind = ("response", None) if i == best else ("revisit", best)
        return (i, len(raw), base64.b32encode(hashlib.sha1(raw).digest()).decode(), *kind)

    assert out == sorted((want(i, h) for i, _, h in rows), key=repr)
