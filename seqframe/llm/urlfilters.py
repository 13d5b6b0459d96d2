"""URL filters as a temporal list join.

A URL list arrives as dated events: on some day an entry was added to or removed
from the list.  Events become validity intervals ``[from_day, to_day)`` (an open end is
null), and every capture is judged against the entries that were active on
the day it was fetched.

Entries are a host (which covers its subdomains) or a host and first path segment,
on the list ``block`` or ``allow``; an active ``allow`` entry overrides.  A
capture yields one key per host suffix, with and without its first path segment,
so every comparison is an equality.  The as-of condition is made an equality too:
intervals are cut at fixed periods of ``PERIOD`` days, captures carry their period,
and both join on (key, period).  An entry has at most a few intervals in a period, so
the join makes few rows a capture however long an entry's history is.

Captures are reduced to distinct (host, segment, day) before the join, so a host holding
a third of all captures contributes one row per day and segment; the verdict
is joined back to the captures (one verdict row per key; a hot key's captures may be split).

A null or unparsable URL has host '' and meets no entry; a null day meets no entry.
Events without entry, list, day or action are ignored; of several events of an entry on
one day, a removal wins.  Repeated rows give repeated results; empty tables are
fine; extra columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from seqframe.llm.common import read

PERIOD = 30
HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]*)"
SEGMENT = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*/([^/?#]*)"


def url_host(url: Column) -> Column:
    host = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), HOST, 1))
    return F.regexp_replace(host, r"\.+$", "")


def url_segment(url: Column) -> Column:
    return F.regexp_extract(F.coalesce(url, F.lit("")), SEGMENT, 1)


def intervals(events: DataFrame) -> DataFrame:
    """``entry, list, from_day, to_day`` from ``entry, list, day, added`` (boolean)."""
    daily = (
        events.select("entry", "list", F.col("day").cast("int").alias("day"), "added")
        .dropna().groupBy("entry", "list", "day").agg(F.min("added").alias("added")))
    # The history of one entry: at most one row per publication day of the list.
    w = Window.partitionBy("entry", "list").orderBy("day")
    return (
        daily.withColumn("to_day", F.lead("day").over(w)).where("added")
        .select("entry", "list", F.col("day").alias("from_day"), "to_day"))


def capture_keys(host: Column, segment: Column) -> Column:
    """Host suffixes of two or more labels, each with and without the first segment."""
    parts = F.split(host, r"\.")
    suffixes = F.transform(
        F.sequence(F.lit(1), F.greatest(F.size(parts) - 1, F.lit(1))),
        lambda i: F.array_join(F.slice(parts, i, F.size(parts)), "."))
    return F.array_distinct(F.concat(
        suffixes, F.transform(suffixes, lambda s: F.concat(s, F.lit("/"), segment))))


def evaluate(captures: DataFrame, events: DataFrame, carry: list[str]) -> DataFrame:
    """``carry`` columns of captures (``url``, ``day`` among the table's) with the verdict:
    ``host, day, n_block, n_allow, blocked, matched`` (smallest active blocking entry)."""
    caps = captures.select(
        *[F.col(c).alias(f"_c{i}") for i, c in enumerate(carry)],
        url_host(F.col("url")).alias("host"), url_segment(F.col("url")).alias("_seg"),
        F.coalesce(F.col("day").cast("int"), F.lit(-1)).alias("day"))
    distinct = caps.select("host", "_seg", "day").distinct()
    keys = distinct.where("host <> '' and day >= 0").select(
        "host", "_seg", "day", F.expr(f"day div {PERIOD}").alias("_period"),
        F.explode(capture_keys(F.col("host"), F.col("_seg"))).alias("entry"))
    spans = intervals(events)
    last = captures.agg(F.max(F.col("day").cast("int"))).first()[0] or 0
    cut = spans.where(F.col("from_day") <= last).select(
        "entry", "list", "from_day", "to_day",
        F.explode(F.expr(
            f"sequence(from_day div {PERIOD}, least(coalesce(to_day - 1, {last}), {last}) div {PERIOD})"
        )).alias("_period"))
    hits = keys.join(cut, ["entry", "_period"]).where(
        "from_day <= day and (to_day is null or day < to_day)")
    verdict = hits.groupBy("host", "_seg", "day").agg(
        F.count_if(F.col("list") == "block").alias("n_block"),
        F.count_if(F.col("list") == "allow").alias("n_allow"),
        F.min(F.when(F.col("list") == "block", F.col("entry"))).alias("matched"))
    zero = F.lit(0).cast("long")
    joined = caps.join(verdict, ["host", "_seg", "day"], "left")
    blocked = (F.coalesce("n_block", zero) > 0) & (F.coalesce("n_allow", zero) == 0)
    return joined.select(
        *[F.col(f"_c{i}").alias(c) for i, c in enumerate(carry)],
        "host", "day", F.coalesce("n_block", zero).alias("n_block"),
        F.coalesce("n_allow", zero).alias("n_allow"), blocked.alias("blocked"),
        F.when(blocked, F.col("matched")).alias("matched"))


# Stand-ins for what the tables lack: a fetch day by page, and a list whose events come
# from the hosts of the table by their md5.
YEAR = 365


def _hex(c: Column, start: int, length: int) -> Column:
    return F.conv(F.substring(F.md5(c), start, length), 16, 10).cast("int")


def captures_of(pages: DataFrame) -> DataFrame:
    return pages.select("page_id", "url", F.pmod("page_id", F.lit(YEAR)).cast("int").alias("day"))


def list_events(pages: DataFrame) -> DataFrame:
    """Hosts whose md5 starts with 0-4 are blocked for 45 days, then again from 120 days after the
    first day; of the (host, segment) pairs, md5 0-3 is allowed for 200 days."""
    urls = pages.select(url_host(F.col("url")).alias("h"), url_segment(F.col("url")).alias("s"))
    hosts = urls.select(F.col("h").alias("entry")).where("h <> ''").distinct()
    paths = urls.where("h <> '' and s <> ''").select(F.concat_ws("/", "h", "s").alias("entry")).distinct()

    def events(entries, name, below, steps):
        day = _hex(F.col("entry"), 2, 3) % YEAR
        return entries.where(_hex(F.col("entry"), 1, 1) < below).select(
            "entry", F.lit(name).alias("list"),
            F.explode(F.array(*[F.struct((day + at).alias("day"), F.lit(add).alias("added"))
                                for at, add in steps])).alias("e")
        ).select("entry", "list", "e.day", "e.added")

    return events(hosts, "block", 5, [(0, True), (45, False), (120, True)]).unionByName(
        events(paths, "allow", 4, [(0, True), (200, False)]))


def op5_url_filter(spark, sf_dir):
    pages = read(spark, sf_dir, "pages")
    return evaluate(captures_of(pages), list_events(pages), ["page_id"])


QUERIES = {"op5_url_filter": op5_url_filter}

_H = f"rtrim(lower(regexp_extract(coalesce(url, ''), '{HOST}', 1)), '.')"
_S = f"regexp_extract(coalesce(url, ''), '{SEGMENT}', 1)"
ORACLE_SQL = {"op5_url_filter": f"""
WITH c AS (
  SELECT page_id, {_H} AS host, {_S} AS seg, (page_id % {YEAR})::INT AS day FROM pages
), e AS (
  SELECT DISTINCT host AS entry, 'block' AS list, 5 AS below, [0, 120] AS adds, [45] AS dels
  FROM c WHERE host <> ''
  UNION ALL SELECT DISTINCT host || '/' || seg, 'allow', 4, [0], [200] FROM c WHERE host <> '' AND seg <> ''
), f AS (
  SELECT entry, list, adds, dels, ('0x' || substr(md5(entry), 2, 3))::INT % {YEAR} AS d
  FROM e WHERE ('0x' || substr(md5(entry), 1, 1))::INT < below
), v AS (
  SELECT entry, list, d + a AS from_day,
    (SELECT min(d + x) FROM unnest(dels) u(x) WHERE x > a) AS to_day
  FROM (SELECT *, unnest(adds) AS a FROM f)
), h AS (
  SELECT c.page_id, v.list, v.entry FROM c JOIN v ON v.from_day <= c.day
    AND (v.to_day IS NULL OR c.day < v.to_day)
    AND (c.host = split_part(v.entry, '/', 1)
      OR ends_with(c.host, '.' || split_part(v.entry, '/', 1)))
    AND (v.list = 'block' OR c.seg = split_part(v.entry, '/', 2))
), g AS (
  SELECT page_id, count(*) FILTER (list = 'block') AS nb, count(*) FILTER (list = 'allow') AS na,
    min(entry) FILTER (list = 'block') AS m
  FROM h GROUP BY page_id
)
SELECT c.page_id, c.host, c.day, coalesce(nb, 0)::BIGINT AS n_block, coalesce(na, 0)::BIGINT AS n_allow,
  coalesce(nb, 0) > 0 AND coalesce(na, 0) = 0 AS blocked,
  CASE WHEN coalesce(nb, 0) > 0 AND coalesce(na, 0) = 0 THEN m END AS matched
FROM c LEFT JOIN g ON c.page_id = g.page_id"""}
