"""The classifier's vote against cosines and votes written out in plain Python."""

import math
import random
import zlib

import numpy as np
import pytest

from seqframe.llm import knnquality
from tests.llm.test_operators import prose


def plain_scores(texts, sample, labels, counts):
    """Scores by loops over the sample; ``sample`` and ``texts`` are texts."""
    x = [knnquality.features(t.encode()).astype(float) for t in sample]
    idf = [math.log((1 + len(x)) / (1 + sum(r[j] > 0 for r in x))) + 1 for j in range(knnquality.WIDTH)]
    weighted = np.array([[v * w for v, w in zip(r, idf, strict=True)] for r in x])
    # Right singular vectors of the sample; cosines do not depend on their signs.
    axes = np.linalg.svd(weighted, full_matrices=False)[2][:knnquality.RANK]

    def project(row):
        z = [sum(a * v * w for a, v, w in zip(axis, row, idf, strict=True)) for axis in axes]
        n = math.sqrt(sum(v * v for v in z))
        return [v / n if n else v for v in z]

    known = [project(r) for r in x]
    share = [counts[v] / labels.count(v) for v in labels]
    out = []
    for t in texts:
        if not t:
            out.append(0.0)
            continue
        z = project(knnquality.features(t.encode()).astype(float))
        sims = sorted(((sum(a * b for a, b in zip(z, k, strict=True)), i) for i, k in enumerate(known)),
                      reverse=True)[:knnquality.NEIGHBOURS]
        votes = [(max(s, 0.0) ** 8 * share[i], labels[i]) for s, i in sims]
        total = sum(w for w, _ in votes)
        out.append(sum(w * v for w, v in votes) / total if total else 0.5)
    return out


def test_scores_match_the_plain_version(spark, docs):
    rng = random.Random(12)
    texts = {}
    for i in range(90):
        good = i % 2
        texts[i] = prose(rng, rng.randint(15, 60)) + ". " if good else "".join(
            rng.choice("!?#$% 0123\n") for _ in range(rng.randint(50, 300)))
    quality = {i: i % 2 for i in range(90)}
    fold = lambda i: zlib.crc32(str(i).encode()) % 5
    learn = [i for i in sorted(quality) if fold(i)]
    labels = spark.createDataFrame(
        [(i, q, 0) for i, q in quality.items()], "doc_id long, quality int, toxic int")
    rows = list(texts.items()) + [(500, None), (501, ""), (None, texts[1]), (1, texts[1])]
    got = knnquality.score(docs(rows, extra=True), labels).collect()
    counts = {v: sum(quality[i] == v for i in learn) for v in (0, 1)}
    want = plain_scores([t or "" for _, t in rows], [texts[i] for i in learn],
                        [quality[i] for i in learn], counts)
    plain = sorted(((i, w) for (i, _), w in zip(rows, want, strict=True)), key=repr)
    found = sorted(((r["doc_id"], r["score"]) for r in got), key=repr)
    assert [i for i, _ in plain] == [i for i, _ in found]
    assert [s for _, s in found] == pytest.approx([s for _, s in plain], abs=2e-3)
    assert all(r["predicted"] == (r["score"] >= 0.3) for r in got)
    assert all(r["held_out"] is (r["doc_id"] is not None and fold(r["doc_id"]) == 0) for r in got)
