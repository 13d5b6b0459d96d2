from pyspark.sql import functions as F

from seqframe.operators.evaluate import accuracy
from seqframe.operators.predict import labelled_probs, top_class
from seqframe.plans import token as T
from seqframe.plans.character import fit_label_vocab
from seqframe.queries import _labelled
from tests.conftest import SF_MID


def test_top_class_tie_goes_to_lowest_index(spark):
    df = spark.createDataFrame([([0.2, 0.4, 0.4],)], "p array<double>")
    r = df.select(top_class(F.col("p"), ["x", "y", "z"]).alias("t"),
                  labelled_probs(F.col("p"), ["x", "y", "z"]).alias("l")).first()
    assert r["t"]["idx"] == 1 and r["t"]["label"] == "y"
    assert [(s["label"], s["p"]) for s in r["l"]] == [("x", 0.2), ("y", 0.4), ("z", 0.4)]


def test_classifier_beats_majority(spark):
    a = _labelled(spark, SF_MID)
    train = a.where(F.col("split") == "train")
    test = a.where(F.col("split") == "test")
    lv = fit_label_vocab(train, None)
    _, pred = T.train_and_score(train, test, lv)
    rows = pred.collect()
    assert len(rows) == test.count()
    for r in rows:
        assert abs(sum(s["p"] for s in r["probs"]) - 1.0) < 1e-9
        assert r["top"]["idx"] == r["prediction"]
    acc = accuracy(pred).first()
    majority = test.groupBy("label").count().agg(F.max("count")).first()[0] / acc["n"]
    assert acc["accuracy"] > majority
    assert acc["n_unlabelled"] == 0


def test_character_classifier_on_prepared_rows(spark):
    from seqframe.plans.character import prepare_characters, train_and_score_characters
    from tests.conftest import SF_SMALL

    a = _labelled(spark, SF_SMALL)
    p = prepare_characters(a.where(F.col("split") == "train"), a.where(F.col("split") == "test"))
    names = T.label_names_of(p.label_vocab)
    _, pred = train_and_score_characters(p.train, p.test, names)
    rows = pred.collect()
    assert len(rows) == p.test.count()
    for r in rows:
        assert abs(sum(s["p"] for s in r["probs"]) - 1.0) < 1e-9
        assert r["top"]["idx"] == r["prediction"] and r["top"]["label"] == names[r["prediction"]]
    acc = accuracy(pred).first()
    majority = p.test.groupBy("label").count().agg(F.max("count")).first()[0] / acc["n"]
    assert acc["accuracy"] > majority


def test_accuracy_without_labelled_rows_is_null(spark):
    from seqframe.operators.evaluate import accuracy

    df = spark.createDataFrame([(-1, 0), (-1, 1)], "Y int, prediction int")
    assert tuple(accuracy(df).first()) == (0, 0, None, 2)


def test_null_text_is_trained_and_scored(spark):
    from pyspark.sql import functions as F

    from seqframe.operators.predict import predict_texts
    from seqframe.plans.token import train_and_score

    rows = [(i, None if i % 5 == 0 else f"{'good' if i % 2 else 'bad'} text {i}", "ab"[i % 2])
            for i in range(40)]
    df = spark.createDataFrame(rows, "row_id long, description string, label string")
    names = spark.createDataFrame([(0, "a"), (1, "b")], "idx int, term string")
    model, scored = train_and_score(df, df, names)
    assert scored.count() == 40
    texts = predict_texts(model, df.withColumnRenamed("description", "text"), ["a", "b"])
    sums = texts.select(F.aggregate("probs", F.lit(0.0), lambda s, x: s + x["p"]).alias("p")).collect()
    assert len(sums) == 40 and all(abs(r["p"] - 1) < 1e-9 for r in sums)


def test_all_label_names_are_kept(spark):
    from seqframe.plans.token import label_names_of

    vocab = spark.range(10_500).selectExpr("cast(id as int) idx", "concat('l', id) term")
    assert len(label_names_of(vocab)) == 10_500

def test_raw_texts_null_and_empty_are_scored(spark):
    from seqframe.operators.predict import predict_texts

    df = spark.createDataFrame([(i, t, "ab"[i % 2]) for i, t in enumerate(
        ["red fish", "blue sky", "red fish swim", "blue sky high", None, ""])],
        "row_id long, description string, label string")
    lv = fit_label_vocab(df, None)
    model, _ = T.train_and_score(df, df, lv)
    rows = predict_texts(model, df, T.label_names_of(lv), text_col="description").collect()
    assert len(rows) == 6
    assert all(abs(sum(c["p"] for c in r["probs"]) - 1) < 1e-9 for r in rows)


def test_rows_left_out_are_counted(spark):
    from seqframe.operators.model import trainable
    from seqframe.operators.index import index_labels

    rows = [(0, "a b", "x", "train"), (1, None, "x", "train"), (2, "c", None, "train"), (3, None, None, "train"),
            (4, "d", "y", "train"), (5, "e", "new", "test"), (6, None, "new", "test"), (7, "f", "x", "test")]
    df = spark.createDataFrame(rows, "row_id long, description string, label string, split string")
    lv = fit_label_vocab(df.where("split = 'train'"), None)
    got = {r["split"]: tuple(r)[1:] for r in T.row_report(df, lv).collect()}
    assert got == {"train": (5, 2, 2, 3), "test": (3, 1, 2, 1)}
    y = index_labels(df.where("split = 'train'"), lv, "label", "Y")
    assert trainable(y).count() == got["train"][3]
    assert T.row_report(df.limit(0), lv).count() == 0


def test_character_features_equal_the_ngram_stages(spark):
    from seqframe.operators.features import ngram_featurizer
    from seqframe.plans.character import _index_strings, character_features

    rows = [(0, 0, [1, 2, 1, 2, -1, 3]), (1, 1, []), (2, 0, None), (3, 1, [5]), (4, -1, [-1, -1, -1]),
            (5, 0, [2147483647, 0, 199, 0])]
    df = spark.createDataFrame(rows, "row_id long, Y int, X array<int>")
    strings = _index_strings(df, "row_id")
    for ns in ((1, 2), (2,), (1, 3)):
        want = ngram_featurizer("S", ns).fit(strings).transform(strings)
        got = character_features(df, ns=ns)
        assert {r["row_id"]: (r["Y"], r["features"]) for r in got.collect()} == {
            r["row_id"]: (r["Y"], r["features"]) for r in want.select("row_id", "Y", "features").collect()}


def test_character_model_reads_stored_vectors_and_takes_index_strings(spark):
    from seqframe.plans.character import _index_strings, train_and_score_characters

    rows = [(i, i % 2, [i % 2, 3, 4 + i % 3]) for i in range(20)]
    df = spark.createDataFrame(rows, "row_id long, Y int, X array<int>")
    model, pred = train_and_score_characters(df, df, ["a", "b"])
    plan = pred._jdf.queryExecution().optimizedPlan().toString()
    assert "features" in plan and "zip_with" not in plan and "UDF(S" not in plan  # vectors are not made again
    again = model.transform(_index_strings(df, "row_id"))
    assert {r["row_id"]: r["prediction"] for r in again.collect()} == {
        r["row_id"]: r["prediction"] for r in pred.collect()}
