"""The whole pipeline against five stages written in plain Python, whole rows compared."""

import hashlib
import random
import re

import corpus_pipeline
from seqframe.llm.common import DOCUMENT_COLUMNS
from tests.llm.conftest import DOCS
from tests.llm.test_operators import brute_leak, prose
from tests.llm.test_sharding import placed


def words_of(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


def repeated_words(words):
    at = {}
    for i in range(len(words) - 7):
        at.setdefault(tuple(words[i:i + 8]), []).append(i)
    return len({i + k for v in at.values() if len(v) > 1 for i in v for k in range(8)})


def normal(line):
    line = re.sub("[A-Z]", lambda m: m.group().lower(), line)
    return " ".join(words_of(re.sub("[0-9]", "0", line)))


def quality_rules(rows):
    holders = {}
    for _, text, _, source, _ in rows:
        for line in (text or "").split("\n"):
            if normal(line):
                holders.setdefault((source, normal(line)), set()).add(text)
    out = []
    for doc_id, text, lang, source, n_chars in rows:
        words = words_of(text)
        if len(words) < 20 or 100 * repeated_words(words) > 30 * len(words):
            continue
        lines = text.split("\n")
        left = [x for x in lines if not normal(x) or len(holders[source, normal(x)]) <= 20]
        n = sum(len(words_of(x)) for x in left)
        if n < 20 or n < 0.3 * len(words):
            continue
        if len(left) < len(lines):
            text = "\n".join(left)
            n_chars = len(text)
        out.append((doc_id, text, lang, source, n_chars))
    return out


def shingles(text):
    words = [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in words_of(text)]
    return {tuple(words[i:i + 5]) for i in range(max(1, len(words) - 4))} if words else set()


def near_duplicates(rows):
    sets = {r[0]: shingles(r[1]) for r in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    ids = sorted(sets)
    for n, i in enumerate(ids):
        for j in ids[n + 1:]:
            both = len(sets[i] & sets[j])
            if both and 100 * both >= 80 * len(sets[i] | sets[j]):
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [r for r in rows if find(r[0]) == r[0]]


def mix_sources(rows):
    names = sorted({r[3] for r in rows if r[3] is not None}) + [None] * any(r[3] is None for r in rows)
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    size = {s: sum(len(words_of(r[1])) for r in rows if r[3] == s) for s in names}
    capped = set()
    while True:
        level = (sum(size.values()) - sum(3 * size[s] for s in capped)) / sum(
            weight[s] for s in names if s not in capped)
        over = {s for s in names if s not in capped and level * weight[s] > 3 * size[s]}
        if not over:
            break
        capped |= over
    out = []
    for s in names:
        budget = 3 * size[s] if s in capped else int(level * weight[s] + 1e-9)
        passes, rest = divmod(budget, size[s])
        mine = sorted((r for r in rows if r[3] == s),
                      key=lambda r: hashlib.md5(f"17|{r[0]}".encode()).hexdigest())
        for r in mine:
            out += [r] * passes
            n = len(words_of(r[1]))
            if n <= rest:
                out.append(r)
            elif rest > 0:
                end = list(re.finditer(r"[^\x20\x09-\x0D]+", r[1]))[rest - 1].end()
                out.append((r[0], r[1][:end], r[2], r[3], end))
            rest = max(0, rest - n)
    return out


def fixture():
    """Sources with boilerplate, near copies, leaks, junk, ties and edge rows; ids are unique."""
    rng = random.Random(21)
    items = [(i, prose(rng, 30)) for i in range(6)]
    rows = []
    for i in range(150):
        source = ["hot", "hot", "a", "b", None][i % 5]
        lines = [prose(rng, rng.randint(8, 20)) for _ in range(4)]
        if source == "hot" and i % 3:
            lines.insert(rng.randrange(5), f"Copyright {i} all rights reserved")  # digits do not count
        if i % 17 == 0:
            lines.insert(2, items[i % 6][1].upper())
        rows.append((i, "\n".join(lines), source))
    for i in range(150, 190):  # chains of copies with a word or two replaced
        words = rows[i % 12][1].split(" ")
        if i % 3:
            words[rng.randrange(len(words))] = "other"
        rows.append((i, " ".join(words), rng.choice(["hot", "b"])))
    rows += [(200, None, "a"), (201, "", "a"), (202, "two words", "a"), (203, "same words " * 40, "b"),
             (204, prose(rng, 8000), "a"), (205, "é😀 " + prose(rng, 40), None),
             (206, rows[3][1], "a"), (207, "\n".join(f"Copyright {k} all rights reserved" for k in range(9)), "hot")]
    return items, [(i, t, "en", s, len(t or "")) for i, t, s in rows]


def test_pipeline_equals_the_plain_version(spark, tmp_path):
    items, rows = fixture()
    extra = spark.createDataFrame(rows, DOCS).selectExpr("*", "'x' as size", "1 as kept", "2 as shard")
    extra.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    good = quality_rules(rows)
    one = near_duplicates(good)
    clean = [r for r in one if not brute_leak(r[1], items)]
    mixed = mix_sources(clean)
    assert len(rows) > len(good) > len(one) > len(clean) and len(mixed) != len(clean)
    assert sum(a != b for a, b in zip(sorted(good), sorted(r for r in rows if r[0] in {g[0] for g in good}),
                                      strict=True)) > 10  # lines were cut
    got = corpus_pipeline.run(spark, str(tmp_path))
    key = lambda r: tuple((v is not None, v or 0) if not isinstance(v, str) else (True, v)
                          for v in r)
    found = got.select(*DOCUMENT_COLUMNS, "size", "text_crc32", "shard", "slot").collect()
    assert sorted((tuple(r)[:5] for r in found), key=repr) == sorted(mixed, key=repr)
    places = placed([(r[0], r[1]) for r in mixed], 8, corpus_pipeline.sharding.SEED)
    assert sorted(((r["doc_id"], r["size"], r["text_crc32"], r["shard"], r["slot"]) for r in found),
                  key=key) == sorted(places, key=key)
