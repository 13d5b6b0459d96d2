"""Plan shape: the physical properties the scale design relies on.

Results are checked elsewhere; these tests read ``executedPlan`` and fail when
a change would put Python in the per-row path, produce all pairs, read
unneeded columns, lose map-side combining, or add a shuffle where the design
has none.
"""

import re

import pytest
from pyspark.sql import functions as F

from seqframe.operators.index import index_sequences
from seqframe.operators.vocab import literal_vocab, term_counts
from seqframe.queries import QUERIES
from tests.conftest import SF_SMALL

# Python evaluation in the row path, or operators that emit all pairs.
FORBIDDEN = (
    "BatchEvalPython",
    "ArrowEvalPython",
    "FlatMapGroupsInPandas",
    "MapInPandas",
    "CartesianProduct",
    "BroadcastNestedLoopJoin",
)
# Columns of `documents` that no query needs.
UNUSED_DOC_COLUMNS = ("source", "n_chars")


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def _read_schemas(df) -> list[str]:
    formatted = df._jdf.queryExecution().explainString(
        df.sparkSession._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    )
    return re.findall(r"ReadSchema: (struct<.*>)", formatted)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_plan_stays_jvm_side_and_pruned(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    plan = _plan(df)
    assert not [op for op in FORBIDDEN if op in plan]
    for schema in _read_schemas(df):
        assert not [c for c in UNUSED_DOC_COLUMNS if f"{c}:" in schema], schema


def _docs(spark):
    return spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").alias("row_id"), F.split(F.lower("text"), "").alias("C")
    )


def test_term_counts_combine_map_side_in_a_hash_aggregate(spark):
    plan = _plan(term_counts(_docs(spark), "C"))
    assert "partial_count" in plan and "partial_min" in plan
    assert "SortAggregate" not in plan
    # No inferred size(...) > 0 filter re-evaluating the sequence expression.
    assert not re.search(r"Filter .*size\(", plan)


def test_array_path_indexing_is_a_projection(spark):
    vocab = literal_vocab(spark, [(0, "e", 9), (1, "t", 8), (2, " ", 7)])
    plan = _plan(index_sequences(_docs(spark), "C", vocab, method="array"))
    assert "Exchange" not in plan and "Join" not in plan


def test_join_path_broadcasts_a_vocabulary_of_checked_size(spark):
    vocab = literal_vocab(spark, [(0, "e", 9), (1, "t", 8), (2, " ", 7)])
    plan = _plan(index_sequences(_docs(spark), "C", vocab, method="join"))
    assert "BroadcastHashJoin" in plan
    assert "SortMergeJoin" not in plan and "ShuffledHashJoin" not in plan


def test_token_indexing_reads_tokens_not_text(spark):
    # The 13 rules run once, into the checkpointed token table; indexing and
    # decoding read that table and never apply the rules again.
    for name in ("token_index", "token_decode"):
        assert "regexp_replace" not in _plan(QUERIES[name](spark, SF_SMALL))
    assert "regexp_replace" in _plan(QUERIES["tokens"](spark, SF_SMALL))
