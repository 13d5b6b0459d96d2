"""Every registered query against its DuckDB oracle on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from seqframe.queries import ORACLE_SQL, QUERIES
from seqframe.sources.testdata import TABLES
from tests.conftest import SF_SMALL


def _norm(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9)
    return v


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(_norm(r[i]) for i in order) for r in rows), key=repr)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF_SMALL}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    q, o = QUERIES, ORACLE_SQL
    assert set(q) <= set(entry.queries()) and set(o) <= set(entry.oracle_sql())
    assert set(o) == set(q)


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_oracle(spark, con, name):
    df = entry.queries()[name](spark, SF_SMALL)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(df.columns) == sorted(rel.columns)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(rel.columns, rel.fetchall())


def test_entry_smoke(spark):
    out = entry.entry(spark)
    rows = out.collect()
    assert sorted((r["split"], r["bucket"]) for r in rows) == [
        (s, b) for s in ("test", "train") for b in (32, 64, 128, 256, 512, 1024)]
    assert sum(r["n"] for r in rows) > 0


def test_lengths_and_labels_need_no_character_vocabulary(spark, monkeypatch):
    def unused(*args, **kwargs):
        raise AssertionError("fits a vocabulary that is not used")

    monkeypatch.setattr("seqframe.plans.character.fit_character_vocab", unused)
    for name in ("bucket_counts", "sliced_count", "batches_per_epoch", "batch_order", "batch_rows",
                 "batch_layout", "label_index"):
        assert QUERIES[name](spark, SF_SMALL).columns
