"""Time the headline queries; print one JSON line.

Environment: BENCH_SF_DIR (default /root/testdata/sf0.1), BENCH_CPUS (default 8),
BENCH_QUERIES (comma list, default the headline set below).
Each query runs to completion through the ``noop`` sink, so nothing is
collected to the driver and the whole plan executes.
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from seqframe.queries import QUERIES  # noqa: E402
from seqframe.session import get_spark  # noqa: E402
from seqframe.sources.testdata import MIN_INPUT_PARTITIONS  # noqa: E402

HEADLINE = [
    "char_vocab",
    "token_vocab",
    "char_index",
    "token_index",
    "bucket_counts",
    "batches",
    "fixed_batches_train",
    "sample_exact",
    "accuracy",
]


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    names = [q for q in os.environ.get("BENCH_QUERIES", ",".join(HEADLINE)).split(",") if q]
    spark = get_spark(
        f"local[{cpus}]",
        shuffle_partitions=max(8, 2 * cpus),
        extra={
            "spark.driver.memory": "16g",
            # The test tables are single row groups; spread them over the cores.
            MIN_INPUT_PARTITIONS: str(cpus),
        },
    )
    # Warm the JVM and the parquet footer cache outside the timings.
    spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id").count()
    timings: dict[str, float] = {}
    for name in names:
        t0 = time.perf_counter()
        QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
        timings[name] = round(time.perf_counter() - t0, 3)
    sf = os.path.basename(sf_dir).removeprefix("sf")
    print(json.dumps({
        "metric": "headline_queries_total",
        "value": round(sum(timings.values()), 3),
        "unit": "sec",
        "queries": timings,
        "sf": float(sf) if sf.replace(".", "", 1).isdigit() else sf,
        "cpus": cpus,
    }))
    spark.stop()


if __name__ == "__main__":
    main()
