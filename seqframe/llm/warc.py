"""WARC archives with a two-level capture index.

Writing: every page becomes one gzip member in a ``.warc.gz`` file, a ``response`` with
the payload or, when another page with a larger id has the same payload, a ``revisit`` that names
it.  A task writes its own files, named by a fresh uuid, through the archive folder's
file system; only files named in the task's committed output count, so a failed or repeated
attempt leaves nothing that is read.

Index: captures are range-sorted by reversed-host URL key (SURT) and written as shards of compressed
blocks of ``BLOCK`` lines, at most about ``SHARD_ROWS`` captures a shard.  Level one is the sparse
directory, one row per block with its first key; it stays a table, split by shard.  Level two are the
blocks.  A lookup sends each key to the shards whose key range holds it (by binary search over one bound
per shard) and sorts it behind the shard's directory; a task holds one shard's directory and one block
while keys stream past in order: it finds a key's first block by binary search, range-reads that block
and the following ones as long as they can hold the key, and yields record addresses.  Records are then
range-read in file order.

The html is shuffled once, by page id.  Keys with any number of captures spread over shards, since
captures are sorted by key and id.

A null html is an empty payload, a null url an empty key.  Null page ids are never
referred to while another page has the payload.  Repeated page ids are separate records.  Tabs and line
ends in keys count as spaces, a scheme's own port as none.  An empty table gives no files and an empty
result; extra columns are ignored.  Folders are those that ``pyarrow.fs`` opens (local, HDFS, S3, GCS).
"""

from __future__ import annotations

import base64
import hashlib
import uuid
import zlib
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import read, store
from seqframe.session import scratch_dir

BLOCK = 512
SHARD_ROWS = 1 << 19
ANSWERS = 1 << 14
FILE_BYTES = 1 << 30
DATE = "2024-06-01T00:00:00Z"
_CRLF = b"\r\n"


def surt(url: str | None) -> str:
    """Reversed-host key: ``https://Blog.Example.org:8443/a?b`` -> ``org,example,blog:8443)/a?b``."""
    rest = (url or "").split("#", 1)[0]
    scheme, mark, after = rest.partition("://")
    scheme, rest = (scheme, after) if mark else ("", rest)
    cut = min([rest.find(c) for c in "/?" if c in rest], default=len(rest))
    host, colon, port = rest[:cut].rpartition("@")[2].lower().rpartition(":")
    if not colon or (port and not port.isdigit()):  # no port, or part of an address in brackets
        host, port = host + colon + port, ""
    if port == {"http": "80", "https": "443"}.get(scheme.lower()):
        port = ""
    name = ",".join(reversed(host.rstrip(".").split(".")))
    return name + (f":{port}" if port else "") + ")" + (rest[cut:] or "/")


def digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def record(page_id, url: str | None, payload: bytes, refers_to) -> bytes:
    """One uncompressed WARC record; ``refers_to`` makes it a revisit."""
    http = (b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: "
            + str(len(payload)).encode() + b"\r\n\r\n")
    body = http if refers_to is not None else http + payload
    head = [
        "WARC/1.1",
        f"WARC-Type: {'response' if refers_to is None else 'revisit'}",
        f"WARC-Record-ID: <urn:page:{'' if page_id is None else page_id}>",
        f"WARC-Date: {DATE}",
        f"WARC-Target-URI: {quote(url or '', safe='!#$%&()*+,/:;=?@[]~' + chr(39))}",
        f"WARC-Payload-Digest: sha1:{digest(payload)}",
    ]
    if refers_to is not None:
        head += [f"WARC-Refers-To: <urn:page:{refers_to}>",
                 "WARC-Profile: http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"]
    head += ["Content-Type: application/http;msgtype=response", f"Content-Length: {len(body)}"]
    return "\r\n".join(head).encode() + _CRLF * 2 + body + _CRLF * 2


def parse(raw: bytes) -> tuple:
    """``page_id, payload_bytes, payload_digest, record_type, refers_to`` of one record."""
    head, _, rest = raw.partition(_CRLF * 2)
    fields = dict(x.split(": ", 1) for x in head.decode().split("\r\n")[1:])
    body = rest[:int(fields["Content-Length"])]
    http, _, payload = body.partition(_CRLF * 2)
    size = int(http.rpartition(b"Content-Length: ")[2])
    urn = lambda name: int(x) if (x := fields[name][len("<urn:page:"):-1]) else None
    name = fields["WARC-Payload-Digest"].removeprefix("sha1:")
    if fields["WARC-Type"] == "response":
        if len(payload) != size or digest(payload) != name:
            raise ValueError(f"damaged record {fields['WARC-Record-ID']}")
        return urn("WARC-Record-ID"), size, name, "response", None
    return urn("WARC-Record-ID"), size, name, "revisit", urn("WARC-Refers-To")


def _member(data: bytes) -> bytes:
    z = zlib.compressobj(1, zlib.DEFLATED, 31)
    return z.compress(data) + z.flush()


class _Files:
    """Rolling output files of one task attempt."""

    def __init__(self, folder: str, suffix: str):
        self.fs, self.root = fs.FileSystem.from_uri(folder)
        self.suffix, self.out, self.at, self.name = suffix, None, 0, ""

    def write(self, data: bytes) -> tuple[str, int]:
        if self.out is None or self.at >= FILE_BYTES:
            self.close()
            self.name, self.at = f"{uuid.uuid4().hex}{self.suffix}", 0
            self.out = self.fs.open_output_stream(f"{self.root}/{self.name}", compression=None)
        self.out.write(data)
        start, self.at = self.at, self.at + len(data)
        return self.name, start

    def close(self):
        if self.out is not None:
            self.out.close()
            self.out = None


def _make_folder(folder: str) -> str:
    where, root = fs.FileSystem.from_uri(folder)
    where.create_dir(root, recursive=True)
    return folder


def write_archive(pages: DataFrame, folder: str) -> DataFrame:
    """Write all pages as WARC files; the captures ``key, page_id, file, offset, length``."""
    payload = F.coalesce(F.col("html").cast("binary"), F.lit(b""))
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", payload.alias("html"))
    prints = store(rows.select("page_id", F.sha2("html", 256).alias("print")).distinct(), "prints")
    # The smaller ids of payloads that several pages share; all others are responses.
    best = prints.groupBy("print").agg(F.max("page_id").alias("best"), F.count("*").alias("n"))
    revisits = prints.join(best.where("n > 1"), "print").where(
        ~F.col("page_id").eqNullSafe(F.col("best"))).select("page_id", "print", "best")
    # Joined on id and payload, so an id that repeats with several payloads is told apart.
    name = F.coalesce(F.col("page_id").cast("string"), F.lit("")).alias("_p")
    joined = rows.select("*", name, F.sha2("html", 256).alias("print")).join(
        revisits.select(name, "print", "best"), ["_p", "print"], "left").select("page_id", "url", "html", "best")
    _make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, ".warc.gz")
        try:
            for b in batches:
                out = []
                for page_id, url, html, refers in zip(*(c.to_pylist() for c in b.columns),
                                                      strict=True):
                    data = _member(record(page_id, url, html, refers))
                    name, at = files.write(data)
                    out.append((surt(url), page_id, name, at, len(data)))
                yield _batch(out, CAPTURE)
        finally:
            files.close()

    return store(joined.mapInArrow(run, _spark(CAPTURE)), "captures")


CAPTURE = pa.schema([("key", pa.string()), ("page_id", pa.int64()), ("file", pa.string()),
                     ("offset", pa.int64()), ("length", pa.int64())])
DIRECTORY = pa.schema([("shard", pa.int64()), ("first", pa.string()), ("last", pa.string()),
                       ("file", pa.string()), ("offset", pa.int64()), ("length", pa.int64())])


def _spark(schema: pa.Schema) -> str:
    return ", ".join(f"`{f.name}` {'long' if f.type == pa.int64() else 'string'}" for f in schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) or [()] * len(schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _plain(key: str):
    """Tabs and line ends separate the fields of an index line; keys hold neither."""
    return F.regexp_replace(key, r"[\t\r\n]", " ")


def write_index(captures: DataFrame, folder: str) -> DataFrame:
    """Write sorted, compressed blocks; the directory ``shard, first, last, file, offset, length``."""
    n = max(int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions")),
            -(-captures.count() // SHARD_ROWS))
    ranged = captures.withColumn("key", _plain("key")).repartitionByRange(
        n, "key", "page_id", "file", "offset").sortWithinPartitions(
        "key", "page_id", "file", "offset").withColumn("shard", F.spark_partition_id().cast("long"))
    _make_folder(folder)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        files = _Files(folder, ".cdx.gz")
        lines: list[tuple] = []

        def flush(part):
            data = _member("".join(
                f"{k}\t{'' if p is None else p}\t{f}\t{o}\t{z}\n" for k, p, f, o, z, _ in part).encode())
            name, at = files.write(data)
            return part[0][5], part[0][0], part[-1][0], name, at, len(data)

        try:
            for b in batches:
                lines += zip(*(c.to_pylist() for c in b.columns), strict=True)
                full = len(lines) // BLOCK * BLOCK
                if full:
                    yield _batch([flush(lines[i:i + BLOCK]) for i in range(0, full, BLOCK)], DIRECTORY)
                    lines = lines[full:]
            if lines:
                yield _batch([flush(lines)], DIRECTORY)
        finally:
            files.close()

    return store(ranged.mapInArrow(run, _spark(DIRECTORY)), "directory")


def lookup(keys: DataFrame, directory: DataFrame, folder: str) -> DataFrame:
    """All captures of the keys (column ``key``): ``key, page_id, file, offset, length``."""
    # One row per index shard.
    bounds = directory.groupBy("shard").agg(F.min("first"), F.max("last")).orderBy("shard").collect()
    firsts, lasts, shards = [b[1] for b in bounds], [b[2] for b in bounds], [b[0] for b in bounds]

    def route(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = [(shards[i], k) for k in b.column("key").to_pylist()
                   for i in range(bisect_left(lasts, k), bisect_right(firsts, k))]
            yield _batch(out, pa.schema([("shard", pa.int64()), ("key", pa.string())]))

    def search(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Per shard its directory rows, then the keys asked of it, both in order."""
        where, root = fs.FileSystem.from_uri(folder)
        shard, name, handle = None, None, None
        starts, ends, places, at, entries = [], [], [], -1, {}
        for b in batches:
            out = []
            for s, key, last, file, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if s != shard:
                    shard, starts, ends, places, at = s, [], [], [], -1
                if file is not None:
                    starts.append(key)
                    ends.append(last)
                    places.append((file, offset, length))
                    continue
                for i in range(bisect_left(ends, key), bisect_right(starts, key)):
                    if i != at:  # keys come sorted, so a block is read once
                        f, o, n = places[i]
                        if f != name:
                            if handle is not None:
                                handle.close()
                            name, handle = f, where.open_input_file(f"{root}/{f}")
                        at, entries = i, _entries(zlib.decompress(handle.read_at(n, o), 31))
                    out += entries.get(key, ())
                    if len(out) >= ANSWERS:
                        yield _batch(out, CAPTURE)
                        out = []
            yield _batch(out, CAPTURE)
        if handle is not None:
            handle.close()

    asked = keys.select(_plain("key").alias("key")).distinct().mapInArrow(route, "shard long, key string")
    blocks = directory.select("shard", F.col("first").alias("key"), "last", "file", "offset", "length")
    both = blocks.unionByName(asked, allowMissingColumns=True)
    n = max(int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions")), len(shards))
    return both.repartition(n, "shard").sortWithinPartitions(
        "shard", F.col("file").isNull(), "key", "last", "file", "offset").select(
        "shard", "key", "last", "file", "offset", "length").mapInArrow(search, _spark(CAPTURE))


def _entries(block: bytes) -> dict[str, list[tuple]]:
    """The captures of an index block by key."""
    out: dict[str, list[tuple]] = {}
    for line in block.decode().split("\n")[:-1]:
        k, p, f, o, z = line.split("\t")
        out.setdefault(k, []).append((k, int(p) if p else None, f, int(o), int(z)))
    return out


def read_records(captures: DataFrame, folder: str) -> DataFrame:
    """Range-read and parse the captured records, in file order."""
    schema = pa.schema([("page_id", pa.int64()), ("payload_bytes", pa.int64()),
                        ("payload_digest", pa.string()), ("record_type", pa.string()),
                        ("refers_to", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        where, root = fs.FileSystem.from_uri(folder)
        name, handle = None, None
        for b in batches:
            out = []
            for f, offset, length in zip(*(c.to_pylist() for c in b.columns), strict=True):
                if f != name:
                    if handle is not None:
                        handle.close()
                    name, handle = f, where.open_input_file(f"{root}/{f}")
                out.append(parse(zlib.decompress(handle.read_at(length, offset), 31)))
            yield _batch(out, schema)
        if handle is not None:
            handle.close()

    n = int(captures.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    # Stretches of a file go to one task, so reads are sequential and a large file is shared out.
    stretch = F.expr("offset div 16777216")
    return captures.select("file", "offset", "length", stretch.alias("s")).repartition(
        n, "file", "s").sortWithinPartitions("file", "offset").select(
        "file", "offset", "length").mapInArrow(run, _spark(schema))


def keys_of(pages: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [pa.array([surt(u) for u in b.column("url").to_pylist()], pa.string())], ["key"])

    return pages.select("url").mapInArrow(run, "key string")


def op8_warc_index(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    folder = scratch_dir(spark, "warc")
    captures = write_archive(pages, f"{folder}/archive")
    directory = write_index(captures, f"{folder}/index")
    found = lookup(keys_of(pages), directory, f"{folder}/index")
    return read_records(found, f"{folder}/archive")


QUERIES = {"op8_warc_index": op8_warc_index}
ORACLE_SQL: dict[str, str] = {}  # DuckDB has no base-32 SHA-1; an exact round trip is in tests/llm
