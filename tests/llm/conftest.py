import pytest

DOCS = "doc_id long, text string, lang string, source string, n_chars long"


@pytest.fixture
def docs(spark):
    """Documents from (doc_id, text) or (doc_id, text, source); more columns with clashing names."""

    def make(rows, extra=False):
        full = [(r[0], r[1], "en", r[2] if len(r) > 2 else "a", len(r[1] or "")) for r in rows]
        df = spark.createDataFrame(full, DOCS)
        if extra:
            for c in ("size", "kept", "k", "_k", "target", "slot", "score", "lines", "_slice"):
                df = df.selectExpr("*", f"'x' as `{c}`")
        return df

    return make
