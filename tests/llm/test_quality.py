"""The limit on frequent lines at hosts of different sizes."""

import random

from seqframe.llm import quality
from tests.llm.test_operators import by_id, prose


def test_limit_does_not_grow_with_the_host(docs):
    rng = random.Random(9)
    line, rare = "shared line of the host", "line of twenty documents"
    rows = [(i, prose(rng, 30) + (f"\n{line}" if i <= 20 else "") + (f"\n{rare}" if i < 20 else ""), "big")
            for i in range(400)]  # 21 and 20 documents of 400
    rows += [(1000 + i, f"{prose(rng, 4)}\n{line}", "big") for i in range(3)]
    out = by_id(quality.judge(docs(rows)))
    assert all(out[i]["n_removed_words"] == (5 if i <= 20 or i >= 1000 else 0) for i in out)
    texts = by_id(quality.filter_documents(docs(rows)))
    assert len(texts) == 400 and not any(line in r["text"] for r in texts.values())
    assert sum(rare in r["text"] for r in texts.values()) == 20
