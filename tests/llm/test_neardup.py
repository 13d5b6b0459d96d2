"""Near duplicates: the bound on differences as an inequality, and families at the edge of the threshold."""

import random

from seqframe.llm import neardup
from tests.llm.test_operators import brute_components, prose


def test_bound_holds_for_random_sets(spark):
    """``at_least`` never exceeds the true difference, whether or not the common class is still open."""
    rng = random.Random(9)
    rows, truth = [], []
    for _ in range(3000):
        base = list(range(rng.randint(20, 90)))
        sets = []
        for part in range(5):  # x, y, the class h both were compared with, two more open classes
            kept = {b for b in base if rng.random() < rng.choice([0.6, 0.9, 1.0])}
            sets.append(kept | {1000 * rng.choice([part, part, 7]) + rng.randrange(60)
                                for _ in range(rng.randint(0, 30))})
        x, y, h, *others = sets
        open_now = [s for s in others if rng.random() < 0.5] + [h] * (rng.random() < 0.5)
        known = rng.random() < 0.8  # else never compared with h

        def own(a, b, rest):
            return len(a - b.union(*rest))

        rows.append((len(x), own(x, y, [h, *others]), own(x, y, open_now), len(x & h) if known else None,
                     len(y), own(y, x, [h, *others]), own(y, x, open_now), len(y & h)))
        truth.append((len(x - y), len(y - x)))
    fields = ["n", "own0", "own", "both"]
    df = spark.createDataFrame(rows, ", ".join(f"{p}_{f} long" for p in "xy" for f in fields)).coalesce(1)
    for p in "xy":
        df = df.selectExpr("*", "named_struct(" + ", ".join(f"'{f}', {p}_{f}" for f in fields) + f") as {p}")
    found = df.selectExpr(f"{neardup.at_least('x', 'y', 'both')} as xy",
                          f"{neardup.at_least('y', 'x', 'both')} as yx").collect()
    assert all(r["xy"] <= a and r["yx"] <= b for r, (a, b) in zip(found, truth, strict=True))
    assert sum(r["xy"] == a for r, (a, _) in zip(found, truth, strict=True)) > 100  # and is often exact


def test_bound_of_shingles_shared_with_a_dropped_hub(spark):
    """B = 90, hub B + 24, x B + 20, y is x less 13 of B: x has 13 that y lacks, all of them in the hub."""
    df = spark.range(1).selectExpr(
        "named_struct('n', 110L, 'own0', 0L, 'own', 13L, 'both', 90L) as x",
        "named_struct('n', 97L, 'own0', 0L, 'own', 0L, 'both', 77L) as y")
    assert df.selectExpr(neardup.at_least("x", "y", "both")).first()[0] == 13


def test_template_families_below_the_threshold(docs):
    """Members share a template but are not linked through it; pairs inside are near copies."""
    rng = random.Random(21)
    rows = []
    for family in range(3):
        base = prose(rng, 90).split()
        for _ in range(20):
            words = base[:70] + prose(rng, 22 + family).split()
            rows.append((len(rows), " ".join(words)))
            if rng.random() < 0.5:  # a near copy that differs inside the template
                other = list(words)
                for at in rng.sample(range(70), rng.randint(1, 2)):
                    other[at] = f"edit{rng.randrange(10**6)}"
                rows.append((len(rows), " ".join(other)))
    rng.shuffle(rows)
    want = {d: c for (d, _), (_, c) in zip(rows, brute_components(rows), strict=True)}
    got = {r["doc_id"]: r["component_id"] for r in neardup.near_duplicates(docs(rows)).collect()}
    assert got == want and len(set(want.values())) < len(rows)
