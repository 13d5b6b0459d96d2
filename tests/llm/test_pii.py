"""Personal data against the plain patterns, validators by hand, context, edge rows."""

import hashlib
import random
import re
import time

from hypothesis import given, settings
from hypothesis import strategies as st

from seqframe.llm import pii

# The contract's patterns as stated, matched by the plain engine.
PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain_luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x if x < 10 else x - 9
    return total % 10 == 0


def plain_base(text):
    out = []
    for k, kind in enumerate(PLAIN):
        for m in re.finditer(PLAIN[kind], text or ""):
            d = re.sub("[^0-9]", "", m[0])
            if (kind == "email" or kind == "ip" and all(int(x) <= 255 for x in m[0].split("."))
                    or kind == "card" and 14 <= len(d) <= 19 and plain_luhn(d)
                    or kind == "phone" and 10 <= len(d) <= 15):
                out.append((m.start(), k, kind, m.end()))
    return [(kind, a, b) for a, _, kind, b in sorted(out)]


PIECES = st.sampled_from([
    "a", "b.c", "@", ".", "1", "0", "255", "256", "4111111111111111", "4111 1111 1111 1111", "+", "-",
    " ", "(017)", "555", "é", "😀", "x@y.z", "+1 (017) 555-7713", "10.0.0.1", "_", "%", "\n", "0" * 15])


@settings(max_examples=600, deadline=None)
@given(st.lists(PIECES, max_size=24).map("".join))
def test_base_spans_are_those_of_the_plain_patterns(text):
    assert [(s.kind, s.start, s.end) for s in pii.spans_of(text) if s.base] == plain_base(text)


def test_query_on_every_row(spark, docs):
    rng = random.Random(3)
    rows = [(1, None), (2, ""), (3, "  "), (None, "me@x.org"), (4, "1.2.3.4 " * 3), (4, "1.2.3.4 " * 3),
            (5, "é😀 4111-1111-1111-1111, +44 20 7946 0958 or a.b@c.de"),
            (6, "".join(rng.choice("a1.@+- (é") for _ in range(200_000)))]
    out = pii.find_pii(docs(rows, extra=True), carry=["lang"]).collect()
    assert sorted((str(r["doc_id"]), [(s.kind, s.start, s.end) for s in r["spans"] if s.base]) for r in out) \
        == sorted((str(i), plain_base(t)) for i, t in rows)
    texts = {i: t for i, t in rows}
    assert all(texts[r["doc_id"]][s.start:s.end] == s["value"] for r in out for s in r["spans"])
    assert pii.find_pii(docs([])).count() == 0


def test_digest_columns(spark, tmp_path, docs):
    rows = [(1, None), (2, "mail a@b.cd from 10.0.0.1"), (3, "IBAN DE89 3704 0044 0532 0130 00, ip 1.1.1.1")]
    docs(rows).write.parquet(f"{tmp_path}/documents.parquet")
    got = {r["doc_id"]: r for r in pii.op12_pii(spark, str(tmp_path)).collect()}
    digest = lambda i: hashlib.sha256(",".join(
        f"{k}:{a}:{b}" for k, a, b in plain_base(dict(rows)[i])).encode()).hexdigest()
    assert all(got[i]["base_sha256"] == digest(i) for i in (1, 2, 3))
    assert (got[2]["n_email"], got[2]["n_ip"], got[2]["n_card"], got[2]["n_phone"]) == (1, 1, 0, 0)
    assert got[1]["spans"] == "" and got[2]["spans"] == "email:5:11,ip:17:25"
    assert got[3]["spans"] == "iban:5:32,ip:37:44"


def kinds(text):
    return [s.kind for s in pii.spans_of(text)]


def test_own_kinds_need_checksum_and_context():
    assert kinds("pay to GB82 WEST 1234 5698 7654 32 now") == ["iban"]
    assert kinds("pay to GB83 WEST 1234 5698 7654 32 now") == []  # mod 97
    assert kinds("GB82WEST12345698765432X") == []  # not the country's length
    assert kinds("my social security number is 078-05-1120") == ["ssn"]
    assert kinds("part 078-05-1120") == kinds("ssn 666-05-1120") == []
    assert kinds("call me: (017) 555-7713") == ["local_phone"]
    assert kinds("(017) 555-7713") == []
    assert kinds("visa 4222222222222") == ["card13"] and kinds("isbn 4222222222222") == []
    assert kinds("call +1 (017) 555-7713") == ["phone"]  # no second span inside it


def test_context_changes_the_score_of_base_spans_but_keeps_them():
    score = lambda t: pii.spans_of(t)[0].score
    assert score("server 1.2.3.4") > score("lo 1.2.3.4") > score("version 1.2.3.4")


def test_long_runs_take_linear_time():
    for text in ("a" * 2_000_000, "1" * 1_000_000, "1 " * 1_000_000, "@" * 1_000_000, "a@" * 500_000,
                 "+1" * 500_000, "1." * 500_000, "+1" + "(" * 1_000_000, "A1" * 500_000, "12-" * 300_000):
        t0 = time.perf_counter()
        pii.spans_of(text)
        assert time.perf_counter() - t0 < 10


def test_redact(docs):
    rows = [(1, "write a@b.cd or +1 (017) 555-7713."), (2, None), (3, "plain"), (4, "")]
    got = {r["doc_id"]: r["text"] for r in pii.redact(docs(rows, extra=True)).collect()}
    assert got == {1: "write <email> or <phone>.", 2: None, 3: "plain", 4: ""}
