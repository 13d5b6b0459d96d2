"""Personal data: patterns propose spans, checksums confirm them, nearby words adjust the score.

Four base kinds are always kept when their pattern and validator agree: ``email``, ``ip`` (parts at
most 255), ``card`` (14 to 19 digits passing Luhn) and ``phone`` (international, 10 to 15 digits).
Matches of a kind are the leftmost non-overlapping ones; a match that its validator refuses is
dropped and not tried again shorter or later.  Four more kinds are the method's own:

* ``iban``: country's length and the mod-97 checksum;
* ``card13``: 13 digits passing Luhn, near a word such as "card";
* ``ssn``: three, two and four digits in the valid ranges, near a word such as "social security";
* ``local_phone``: ten grouped digits without a country code, near a word such as "call".

A proposal starts with its kind's prior.  A context word within ``NEAR`` characters raises the score,
one that speaks against it (a version, an order number) lowers it.  Proposals of the method's own
kinds need ``ACCEPT``; base spans stay whatever their score.  A proposal of an own kind that overlaps a
base span is dropped unless it holds that span whole and more.

Every pattern is matched in linear time, also on one run of a million digits or of letters without an
``@``.  Offsets are code points, ends exclusive.  Null and empty texts have no spans; a null
``doc_id`` stays null; repeated rows give repeated results; an empty table gives an empty result;
further columns are ignored unless named in ``carry``.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator, Sequence
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from seqframe.llm.common import read

BASE_KINDS = ["email", "ip", "card", "phone"]
OWN_KINDS = ["iban", "card13", "ssn", "local_phone"]
KINDS = BASE_KINDS + OWN_KINDS
NEAR = 48
ACCEPT = 0.6

LOCAL_PART = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
_DOMAIN = re.compile(r"[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
# A digit run that begins no address is consumed whole: no later start inside it could match.
_IP = re.compile(r"[0-9]++(\.[0-9]++\.[0-9]++\.[0-9]++)?")
_CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
_PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
_IBAN = re.compile(r"(?<![A-Za-z0-9])[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]){11,30}")
_SSN = re.compile(r"(?<![0-9-])([0-9]{3})-([0-9]{2})-([0-9]{4})(?![0-9-])")
_LOCAL = re.compile(r"(?<![0-9+(])(?:\([0-9]{3}\) ?|[0-9]{3}[ .-])[0-9]{3}[ .-][0-9]{4}(?![0-9])")

# Length of an IBAN by country.
IBAN_LENGTHS = {
    "AD": 24, "AE": 23, "AL": 28, "AT": 20, "AZ": 28, "BA": 20, "BE": 16, "BG": 22, "BH": 22, "BR": 29,
    "CH": 21, "CR": 22, "CY": 28, "CZ": 24, "DE": 22, "DK": 18, "DO": 28, "EE": 20, "ES": 24, "FI": 18,
    "FO": 18, "FR": 27, "GB": 22, "GE": 22, "GI": 23, "GL": 18, "GR": 27, "GT": 28, "HR": 21, "HU": 28,
    "IE": 22, "IL": 23, "IS": 26, "IT": 27, "JO": 30, "KW": 30, "KZ": 20, "LB": 28, "LI": 21, "LT": 20,
    "LU": 20, "LV": 21, "MC": 27, "MD": 24, "ME": 22, "MK": 19, "MR": 27, "MT": 31, "MU": 30, "NL": 18,
    "NO": 15, "PK": 24, "PL": 28, "PS": 29, "PT": 25, "QA": 29, "RO": 24, "RS": 22, "SA": 24, "SE": 24,
    "SI": 19, "SK": 24, "SM": 27, "TN": 24, "TR": 26, "UA": 29, "VG": 24, "XK": 20,
}

PRIOR = {"email": 0.9, "ip": 0.6, "card": 0.7, "phone": 0.7,
         "iban": 0.8, "card13": 0.4, "ssn": 0.35, "local_phone": 0.35}
FOR, AGAINST = 0.3, 0.3
#: Words beside a span that speak for its kind, and against it (whole words, ASCII lower case).
CONTEXT = {
    "email": ("email e-mail mail contact write", "regex pattern"),
    "ip": ("ip address host server client login addr", "version release section chapter build"),
    "card": ("card credit debit visa mastercard amex payment cc pan", "order invoice tracking isbn serial"),
    "phone": ("phone tel telephone call mobile cell fax contact whatsapp", "order invoice isbn serial"),
    "iban": ("iban account bank transfer konto compte cuenta", "serial part"),
    "card13": ("card credit debit visa payment cc", "order invoice tracking isbn ean gtin serial"),
    "ssn": ("ssn social security taxpayer", "order invoice part model serial"),
    "local_phone": ("phone tel telephone call mobile cell fax", "order invoice isbn serial"),
}
_CONTEXT = {k: tuple(frozenset(x.split()) for x in both) for k, both in CONTEXT.items()}
_WORD = re.compile(r"[a-z][a-z-]*")


class Span(NamedTuple):
    kind: str
    start: int
    end: int
    base: bool
    score: float
    value: str


def luhn(digits: str) -> bool:
    """Every second digit from the right counts double, less 9 if above 9; the sum ends in 0."""
    odd = sum(map(int, digits[-1::-2]))
    return (odd + sum(2 * int(d) - 9 * (d > "4") for d in digits[-2::-2])) % 10 == 0


def mod97(iban: str) -> bool:
    """Letters count 10 to 35; with the first four signs at the end, the number leaves 1 modulo 97."""
    return int("".join(str(int(c, 36)) for c in iban[4:] + iban[:4])) % 97 == 1


def emails(text: str) -> Iterator[tuple[int, int]]:
    """From each ``@`` back over the local part, which holds no ``@``, but not into the last match."""
    low, at = 0, text.find("@")
    while at >= 0:
        before = text[low:at]
        start = low + len(before.rstrip(LOCAL_PART))
        low = at + 1
        if start < at and (m := _DOMAIN.match(text, at + 1)):
            low = m.end()
            yield start, low
        at = text.find("@", low)


def ips(text: str) -> Iterator[tuple[int, int]]:
    for m in _IP.finditer(text):
        if m[1] and all(len(p.lstrip("0")) <= 3 and int(p[-3:]) <= 255 for p in m[0].split(".")):
            yield m.span()


def _digits(text: str) -> str:
    return "".join(c for c in text if "0" <= c <= "9")


def _cards(low: int, high: int) -> Callable[[str], Iterator[tuple[int, int]]]:
    def find(text: str) -> Iterator[tuple[int, int]]:
        for m in _CARD.finditer(text):
            if low <= m.end() - m.start() < 2 * high and low <= len(d := _digits(m[0])) <= high and luhn(d):
                yield m.span()
    return find


def phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _PHONE.finditer(text):
        if 10 <= len(_digits(m[0])) <= 15:
            yield m.span()


def ibans(text: str) -> Iterator[tuple[int, int]]:
    for m in _IBAN.finditer(text):
        n, seen, end = IBAN_LENGTHS.get(m[0][:2], 0), 0, m.start()
        for c in m[0]:
            if seen == n:
                break
            seen, end = seen + (c != " "), end + 1
        after = text[end:end + 1]
        if n and seen == n and not (after.isascii() and after.isalnum()) \
                and mod97(text[m.start():end].replace(" ", "")):
            yield m.start(), end


def ssns(text: str) -> Iterator[tuple[int, int]]:
    for m in _SSN.finditer(text):
        if m[1] not in ("000", "666") and m[1] < "900" and m[2] != "00" and m[3] != "0000":
            yield m.span()


def local_phones(text: str) -> Iterator[tuple[int, int]]:
    for m in _LOCAL.finditer(text):
        yield m.span()


FINDERS = {"email": emails, "ip": ips, "card": _cards(14, 19), "phone": phones, "iban": ibans,
           "card13": _cards(13, 13), "ssn": ssns, "local_phone": local_phones}


def score(text: str, kind: str, start: int, end: int) -> float:
    """The kind's prior, changed by whole words close before or after the span."""
    before, after = text[max(0, start - NEAR):start], text[end:end + NEAR]
    if start > NEAR:  # a cut word is no word
        before = before.partition(" ")[2]
    if end + NEAR < len(text):
        after = after.rpartition(" ")[0]
    words = {*_WORD.findall(before.lower()), *_WORD.findall(after.lower())}
    good, bad = _CONTEXT[kind]
    value = PRIOR[kind] + FOR * bool(words & good) - AGAINST * bool(words & bad)
    return round(min(1.0, max(0.0, value)), 2)


def spans_of(text: str | None) -> list[Span]:
    """All spans of one text by start, then kind as listed."""
    if not text:
        return []
    found = [Span(k, a, b, True, score(text, k, a, b), text[a:b])
             for k in BASE_KINDS for a, b in FINDERS[k](text)]
    ends = sorted((s.start, s.end) for s in found)
    own = [Span(k, a, b, False, score(text, k, a, b), text[a:b])
           for k in OWN_KINDS for a, b in FINDERS[k](text)]
    found += [s for s in own if s.score >= ACCEPT and not _clashes(s, ends)]
    return sorted(found, key=lambda s: (s.start, KINDS.index(s.kind), s.end))


def _clashes(s: Span, base: list[tuple[int, int]]) -> bool:
    return any(a < s.end and s.start < b and not (s.start <= a and b <= s.end and b - a < s.end - s.start)
               for a, b in base)


_SPAN = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64()),
                            ("base", pa.bool_()), ("score", pa.float64()), ("value", pa.string())]))
_SPAN_SQL = ("array<struct<kind: string, start: long, end: long, base: boolean, score: double, "
             "value: string>>")


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at = batch.schema.get_field_index("_text")
        found = [[s._asdict() for s in spans_of(t)] for t in batch.column(at).to_pylist()]
        yield batch.drop_columns(["_text"]).append_column("spans", pa.array(found, _SPAN))


def find_pii(docs: DataFrame, carry: Sequence[str] = ()) -> DataFrame:
    """``doc_id, spans`` and ``carry``: every span with kind, code points, score and matched text."""
    cols = ["doc_id", *[c for c in carry if c != "doc_id"]]
    rows = docs.select(*[F.col(c).alias(f"_c{i}") for i, c in enumerate(cols)],
                       F.col("text").cast("string").alias("_text"))
    kept = ", ".join(f"{c} {t}" for c, t in rows.dtypes if c != "_text")
    found = rows.mapInArrow(_scan, f"{kept}, spans {_SPAN_SQL}")
    return found.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(cols)], "spans")


def _mask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        at, out = batch.schema.get_field_index("text"), []
        for text in batch.column(at).to_pylist():
            parts, end = [], 0
            for s in spans_of(text):
                if s.end <= end:
                    continue
                parts += [text[end:s.start]] * (s.start >= end) + [f"<{s.kind}>"] * (s.start >= end)
                end = s.end
            out.append(text if not end else "".join(parts) + text[end:])
        yield batch.set_column(at, "text", pa.array(out, pa.string()))


def redact(docs: DataFrame) -> DataFrame:
    """The same rows with ``text``'s spans replaced by ``<kind>`` (of overlapping spans, the first's)."""
    schema = ", ".join(f"`{c}` {t}" for c, t in docs.dtypes)
    return docs.mapInArrow(_mask, schema)


def op12_pii(spark, sf_dir):
    found = find_pii(read(spark, sf_dir, "documents"))
    base = F.filter("spans", lambda s: s["base"])

    def told(spans: Column) -> Column:
        return F.array_join(F.transform(
            spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")

    def count(kind: str) -> Column:
        return F.size(F.filter(base, lambda s: s["kind"] == kind)).cast("long").alias(f"n_{kind}")

    return found.select("doc_id", *map(count, BASE_KINDS), F.sha2(told(base), 256).alias("base_sha256"),
                        told(F.col("spans")).alias("spans"))


QUERIES = {"op12_pii": op12_pii}
ORACLE_SQL: dict[str, str] = {}  # SQL gives no offsets of matches; checked by brute force in tests/llm
