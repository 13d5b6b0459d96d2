"""The registered training-data queries and their DuckDB oracles (the pipeline's are in corpus_pipeline)."""

from __future__ import annotations

from seqframe.llm import (
    decontam,
    knnquality,
    licenses,
    manifest,
    mixing,
    neardup,
    pii,
    quality,
    sharding,
    suffixdedup,
    urlfilters,
    variants,
    warc,
)

MODULES = [knnquality, licenses, quality, neardup, urlfilters, mixing, decontam, warc, sharding,
           suffixdedup, manifest, pii, variants]

QUERIES = {name: f for m in MODULES for name, f in m.QUERIES.items()}

ORACLE_SQL = {name: sql for m in MODULES for name, sql in m.ORACLE_SQL.items()}
