from pyspark.sql import functions as F

from seqframe.functions.labels import label_name, with_label_names
from seqframe.operators.index import index_labels, index_sequences, index_with_terms
from seqframe.operators.vocab import build_label_vocab, build_vocab


def _frame(spark):
    return spark.createDataFrame(
        [(0, ["a", "b", "z"]), (1, []), (2, None), (3, ["b", "b", "q", "a"])],
        "row_id long, s array<string>",
    )


def _vocab(spark):
    return spark.createDataFrame([(0, "b", 3), (1, "a", 2)], "idx int, term string, n long")


def _by_row(df, col="X"):
    return {r["row_id"]: r[col] for r in df.collect()}


EXPECTED = {0: [1, 0, -1], 1: [], 2: None, 3: [0, 0, -1, 1]}


def test_array_path(spark):
    out = index_sequences(_frame(spark), "s", _vocab(spark), method="array")
    assert _by_row(out) == EXPECTED


def test_join_path_broadcast(spark):
    out = index_sequences(_frame(spark), "s", _vocab(spark), method="join")
    assert _by_row(out) == EXPECTED


def test_join_path_hot_and_tail(spark):
    # Nothing is small enough to broadcast whole: the most frequent term is
    # looked up by broadcast, the tail through a shuffle join.
    out = index_sequences(_frame(spark), "s", _vocab(spark), method="join",
                          broadcast_max_terms=0, hot_terms=1)
    assert _by_row(out) == EXPECTED


def test_custom_unseen_value(spark):
    df = spark.createDataFrame([(["x", "b"],)], "s array<string>")
    assert df.select(index_with_terms("s", ["b"], unseen=99).alias("x")).first()["x"] == [99, 0]


def test_join_path_matches_array_path_on_documents(spark):
    from tests.conftest import SF_SMALL
    from seqframe.functions.text import chars
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select(
        F.col("doc_id").alias("row_id"), chars("text").alias("c"))
    vocab = build_vocab(docs, "c", cap=30)
    a = _by_row(index_sequences(docs, "c", vocab, method="array"))
    j = _by_row(index_sequences(docs, "c", vocab, method="join", carry=[]))
    h = _by_row(index_sequences(docs, "c", vocab, method="join", carry=[],
                                broadcast_max_terms=0, hot_terms=5))
    assert a == j == h
    assert any(-1 in x for x in a.values())


def test_label_codes_and_unseen_labels(spark):
    df = spark.createDataFrame([(0, 1), (1, 9), (2, None), (3, 4), (4, 1)],
                               "row_id long, indexed_label int")
    named = with_label_names(df)
    assert named.columns == ["row_id", "label"]
    assert _by_row(named, "label") == {0: "World", 1: None, 2: None, 3: "Sci/Tech", 4: "World"}
    lv = build_label_vocab(named, cap=200)
    out = index_labels(named, lv, "label", "Y")
    assert _by_row(out, "Y") == {0: 0, 1: -1, 2: -1, 3: 1, 4: 0}
    other = spark.createDataFrame([("Sports",)], "label string")
    assert index_labels(other, lv).first()["Y"] == -1


def test_label_name_from_string_code(spark):
    df = spark.createDataFrame([("2",), ("NA",)], "c string")
    assert [r[0] for r in df.select(label_name("c")).collect()] == ["Sports", None]


def test_byte_bound_also_decides_the_broadcast(spark):
    from seqframe.operators.vocab import fits_broadcast

    vocab = _vocab(spark)
    assert fits_broadcast(vocab, max_terms=2, max_bytes=2)
    assert not fits_broadcast(vocab, max_terms=2, max_bytes=1)
    out = index_sequences(_frame(spark), "s", vocab, method="join",
                          broadcast_max_bytes=1, hot_terms=1)
    assert _by_row(out) == EXPECTED


def test_long_frequent_terms_stay_out_of_the_hot_broadcast(spark):
    from seqframe.operators.vocab import hot_entry, term_of

    long_term = "w" * 2000
    vocab = spark.createDataFrame([(0, long_term, 9), (1, "a", 5), (2, None, 1), (3, "z", 1)],
                                  "idx int, term string, n long")
    hot = {r["idx"] for r in vocab.where(hot_entry(F.col("idx"), F.col("term"), 3)).collect()}
    assert hot == {1, 2}
    seqs = spark.createDataFrame([(0, long_term), (1, "a"), (2, "q")], "row_id long, s string")
    x = _by_row(index_sequences(seqs.select("row_id", F.array("s").alias("s")), "s", vocab,
                                method="join", broadcast_max_terms=0, hot_terms=3))
    assert x == {0: [0], 1: [1], 2: [-1]}
    pairs = spark.createDataFrame([(0, 0), (1, 3), (2, -1), (3, 7)], "row_id long, idx int")
    named = term_of(vocab, "idx", pairs, broadcast_max_terms=0, hot_terms=3)
    assert _by_row(named, "term") == {0: long_term, 1: "z", 2: None, 3: None}


def test_null_elements_are_no_terms_on_either_path(spark):
    df = spark.createDataFrame([(0, ["a", None, "b"]), (1, [None]), (2, None)],
                               "row_id long, s array<string>")
    vocab = build_vocab(df, "s")
    assert sorted(r["term"] for r in vocab.collect()) == ["a", "b"]
    want = {0: [0, -1, 1], 1: [-1], 2: None}
    assert _by_row(index_sequences(df, "s", vocab, method="array")) == want
    assert _by_row(index_sequences(df, "s", vocab, method="join")) == want
    assert _by_row(index_sequences(df, "s", vocab, method="join", broadcast_max_terms=0,
                                   hot_terms=1)) == want


def test_labels_past_every_bound(spark):
    from seqframe.plans.character import fit_label_vocab
    from seqframe.plans.token import label_names_of

    for n in (300, 10_500):
        df = spark.range(n).select(F.col("id").alias("row_id"),
                                   F.concat(F.lit("l"), "id").alias("label"))
        vocab = fit_label_vocab(df, None)
        assert label_names_of(vocab) == [f"l{i}" for i in range(n)]
        more = df.unionByName(spark.createDataFrame([(-1, None), (-2, "new")], "row_id long, label string"))
        want = {i: i for i in range(n)} | {-1: -1, -2: -1}
        assert _by_row(index_labels(more, vocab), "Y") == want
        assert _by_row(index_labels(more, vocab, broadcast_max_terms=0, hot_terms=20), "Y") == want


def test_a_character_cap_past_the_array_bound(spark):
    from seqframe.plans.character import prepare_characters

    texts = [(i, "".join(chr(0x4E00 + (i * 7 + q) % 600) for q in range(50)), "World")
             for i in range(100)] + [(100, "", "World"), (101, None, "World")]
    df = spark.createDataFrame(texts, "row_id long, description string, label string")
    p = prepare_characters(df, df, cap=1000)
    terms = {r["term"]: r["idx"] for r in p.vocab.collect()}
    assert len(terms) > 256
    want = {i: None if t is None else [terms[c] for c in t] for i, t, _ in texts}
    assert _by_row(p.train) == want


def test_one_unseen_term_in_half_of_the_rows_is_answered_by_broadcast(spark):
    vocab = spark.createDataFrame([(i, f"t{i}", 100 - i) for i in range(50)],
                                  "idx int, term string, n long")
    unseen = "u" * 3000
    df = spark.range(400).select(F.col("id").alias("row_id"), F.array(
        F.when(F.col("id") % 2 == 0, F.lit(unseen)).otherwise(
            F.concat(F.lit("t"), (F.col("id") % 60)))).alias("s"))
    out = index_sequences(df, "s", vocab, method="join", broadcast_max_terms=0, hot_terms=2)
    assert _by_row(out) == {i: [-1 if i % 2 == 0 or i % 60 >= 50 else i % 60] for i in range(400)}
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert plan.count("BroadcastHashJoin") >= 2


def test_split_join_evaluates_its_input_once(spark):
    """Past the broadcast bounds the later steps read the stored first answers, not the exploded texts."""
    import contextlib
    import io

    df = spark.range(40).select(F.col("id").alias("row_id"), F.split(
        F.concat(F.lit("a b hot hot "), (F.col("id") % 7).cast("string")), " ").alias("T"))
    vocab = spark.createDataFrame([(i, t, 1) for i, t in enumerate(["hot", "a", "3", "4"])],
                                  "idx int, term string, n long")
    out = index_sequences(df, "T", vocab, method="join", broadcast_max_terms=1, hot_terms=1)
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        out.explain("extended")
    assert "split(" not in text.getvalue() and "Generate" not in text.getvalue()
    plain = index_sequences(df, "T", vocab, method="join")
    assert sorted(map(tuple, out.collect()), key=repr) == sorted(map(tuple, plain.collect()), key=repr)


def test_bloom_filter_holds_every_term_and_few_others(spark):
    from seqframe.operators.index import bloom_filter, may_hold

    vocab = spark.range(5000).select(F.concat(F.lit("t"), "id").alias("term")).unionByName(
        spark.createDataFrame([(None,), ("",)], "term string"))
    asked = vocab.unionByName(spark.range(5000).select(F.concat(F.lit("u"), "id").alias("term")))
    bloom, words = bloom_filter(vocab, 5000)
    out = may_hold(asked, "term", bloom, words)
    got = {r["term"]: r["_maybe"] for r in out.collect()}
    assert out.count() == asked.count() and got[None] is False and got[""] is True
    assert all(got[f"t{i}"] for i in range(5000))
    assert sum(got[f"u{i}"] for i in range(5000)) < 250
    # A bound on the words lets more through, and loses nothing.
    small, words = bloom_filter(vocab, 5000, max_words=3)
    assert words == 3 and small.count() <= 3
    assert all(r["_maybe"] for r in may_hold(vocab.where("term is not null"), "term", small, words).collect())


def test_unseen_terms_do_not_reach_the_shuffle_join(spark):
    vocab = spark.createDataFrame([(i, f"t{i}", 1) for i in range(200)], "idx int, term string, n long")
    df = spark.range(3000).select(F.col("id").alias("row_id"), F.array(
        F.concat(F.when(F.col("id") % 3 == 0, "t").otherwise("u"), F.col("id"))).alias("s"))
    out = index_sequences(df, "s", vocab, method="join", broadcast_max_terms=0, hot_terms=3)
    assert _by_row(out) == {i: [i if i % 3 == 0 and i < 200 else -1] for i in range(3000)}
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    assert "bit_or" in plan


def test_characters_are_indexed_by_code_point_like_any_term(spark):
    from seqframe.functions.text import chars, ints_to_string
    from seqframe.operators.index import index_characters_with_terms

    texts = ["abc é", "", None, "œ☃😀a", "\u0000zA", "ßɏɐ☃", "-1"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "id int, t string").withColumn("c", chars("t"))
    for terms in (["a", " ", "é", "☃", "ɐ", "ɏ", "😀"], ["b"], []):
        for unseen in (-1, 7):
            rows = df.select(index_with_terms("c", terms, unseen).alias("a"),
                             index_characters_with_terms("c", terms, unseen).alias("b"))
            assert all(r["a"] == r["b"] for r in rows.collect())
    # Rendering runs in generated code: no lambda in the plan.
    assert "lambda" not in df.select(ints_to_string(F.array(F.lit(1), F.col("id")))
                                     )._jdf.queryExecution().analyzed().toString()
