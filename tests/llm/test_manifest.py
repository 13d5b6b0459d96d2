"""The Merkle manifest against a plain recursive tree, with edge rows."""

import hashlib
import random
import re
import zlib

import pytest

from seqframe.llm import manifest

FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_leaf(r, text):
    values = [text if f == "text" else r[f] for f in FIELDS]
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


def plain_tree(nodes):
    """Last node, and per leaf the list of (before, after) on its way up."""
    paths, at, level = [[] for _ in nodes], list(range(len(nodes))), nodes
    while len(level) > 1:
        for i, k in enumerate(at):
            run = level[k // 8 * 8:k // 8 * 8 + 8]
            paths[i].append(("".join(run[:k % 8]), "".join(run[k % 8 + 1:])))
        level, at = [h(*level[s:s + 8]) for s in range(0, len(level), 8)], [k // 8 for k in at]
    return level[0], paths


def plain_manifest(rows):
    langs = {}
    for r in rows:
        langs.setdefault(r["lang"], []).append(r)
    order = sorted(langs, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for g in order:
        mine = sorted(langs[g], key=lambda r: (r["doc_id"] is not None, r["doc_id"] or 0,
                                               plain_leaf(r, r["text"])))
        trees[g] = mine, *plain_tree([plain_leaf(r, r["text"]) for r in mine])
    root, upper = plain_tree([trees[g][1] for g in order])
    out = []
    for g, up in zip(order, upper, strict=True):
        mine, subroot, paths = trees[g]
        for r, path in zip(mine, paths, strict=True):
            text = r["text"]
            if r["doc_id"] is not None and text is not None and zlib.crc32(str(r["doc_id"]).encode()) % 3 == 0:
                text = "".join(c.lower() if "A" <= c <= "Z" else c for c in text)
            cur = plain_leaf(r, text)
            for a, b in path + up:
                cur = h(a, cur, b)
            out.append((r["doc_id"], plain_leaf(r, r["text"]), subroot, root,
                        h(*[a + b for a, b in path + up]), cur, cur == root))
    return sorted(out, key=repr)


def check(spark, rows, extra=()):
    df = spark.createDataFrame([tuple(r[c.split()[0]] for c in SCHEMA.split(", ")) for r in rows], SCHEMA)
    for c in extra:
        df = df.selectExpr("*", f"'x' as `{c}`")
    got = manifest.verify(manifest.manifest(df))
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    assert sorted((tuple(r) for r in got.collect()), key=repr) == plain_manifest(rows)


def row(i, lang="en", text="Some Text", source="a"):
    return {"doc_id": i, "text": text, "lang": lang, "source": source, "n_chars": len(text or "")}


def test_three_levels_hot_group_and_many_groups(spark):
    rng = random.Random(5)
    rows = [row(rng.randrange(10**9) * 7 + k, "en", rng.choice(["Ab", "cd", "ÄB ç"])) for k in range(600)]
    rows += [row(i, f"l{i % 70}", "X") for i in range(300)]
    rng.shuffle(rows)
    check(spark, rows)


def test_edge_rows_and_clashing_columns(spark):
    rows = [row(1, None), row(2, None, None), row(3, "", ""), row(None, "en", "Null Id"), row(None, "en", "Other"),
            row(4, "en", "Tie"), row(4, "en", "Tie"), row(4, "en", "Another"), row(5, "é", "É😀 A" * 50_000),
            row(-6, "fr", None, None), {**row(7, "fr"), "n_chars": None}]
    check(spark, rows + [row(i, "de") for i in range(9)],
          extra=["g", "idx", "size", "node", "seen", "parent", "slot", "path", "root", "before", "_at"])


@pytest.mark.parametrize("n", [1, 2, 8, 9, 64, 65])
def test_run_lengths(spark, n):
    check(spark, [row(i) for i in range(n)])


def test_lone_leaves_only(spark):
    check(spark, [row(i, f"g{i}") for i in range(3)])


def test_empty(spark):
    assert manifest.verify(manifest.manifest(spark.createDataFrame([], SCHEMA))).count() == 0


def test_windows_are_per_run(spark):
    """No window gathers a group: every one is partitioned by the parent too."""
    df = spark.createDataFrame([tuple(row(i).values()) for i in range(20)],
                               "doc_id long, text string, lang string, source string, n_chars long")
    plan = manifest.manifest(df)._jdf.queryExecution().executedPlan().toString()
    windows = [x for x in plan.split("\n") if "Window [lag(" in x or ", lag(" in x]
    assert windows and all(re.search(r"\[g#\d+, parent#\d+L?\], \[idx#", x) for x in windows)
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
