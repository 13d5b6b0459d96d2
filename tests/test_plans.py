import os
import tempfile

from pyspark.sql import functions as F

from seqframe.plans.character import character_batches, preprocess_csv
from seqframe.sources import read_frame, read_vocab


def test_preprocess_job_from_csv(spark):
    d = tempfile.mkdtemp(prefix="seqframe-job-")
    rows = [(1 + i % 4, f"title {i}", f"Text number {i}, with (some) words? {'x' * (i % 50)}")
            for i in range(120)]
    df = spark.createDataFrame(rows, "indexed_label int, title string, description string")
    # headerless CSV files, like the raw article files
    for name, part in (("train", df.where(F.col("title") != "title 5")),
                       ("test", df.where(F.col("title") == "title 5"))):
        part.write.option("quote", '"').option("escape", '"').csv(os.path.join(d, name))
    out = preprocess_csv(spark, os.path.join(d, "train"), os.path.join(d, "test"),
                         os.path.join(d, "out"))
    vocab = read_vocab(spark, out["char_vocab"]).orderBy("idx").collect()
    assert vocab[0]["term"] == "x" and len(vocab) <= 200
    counts = [r["n"] for r in vocab]
    assert counts == sorted(counts, reverse=True)
    labels = read_vocab(spark, out["label_vocab"]).collect()
    assert {r["term"] for r in labels} == {"World", "Sports", "Business", "Sci/Tech"}
    train = read_frame(spark, out["train"])
    assert train.count() == 119 and set(train.columns) >= {"label", "X", "Y", "row_id"}
    batches = character_batches(train, batch_size=12, buckets=[32, 64, 128]).collect()
    assert all(b["n_rows"] == 12 for b in batches)
    assert sorted(b["batch_seq"] for b in batches) == list(range(len(batches)))


def test_pluggable_splitter(spark):
    from pyspark.sql import functions as F

    from seqframe.plans.character import prepare_characters

    df = spark.createDataFrame(
        [(0, "a b a", "World"), (1, "b c", "Sports"), (2, "c c d", "World")],
        "row_id long, description string, label string")
    words = lambda c: F.split(c, " ")
    p = prepare_characters(df.where("row_id < 2"), df.where("row_id = 2"), cap=10, splitter=words)
    assert [r["term"] for r in p.vocab.orderBy("idx").collect()] == ["a", "b", "c"]
    assert p.test.first()["X"] == [2, 2, -1] and p.test.first()["length"] == 3


def test_prepare_tokens_matches_plain_python(spark):
    from seqframe.plans.token import prepare_tokens
    from tests.reference_model import py_pad, py_tokens, py_vocab

    texts = ["It's a test, isn't it?", "No (really) it's fine!", "a a b", "",
             "Unseen words, it's here"]
    labels = ["World", "Sports", "World", "Business", "Sci/Tech"]
    df = spark.createDataFrame([(i, t, lab) for i, (t, lab) in enumerate(zip(texts, labels))],
                               "row_id long, description string, label string")
    p = prepare_tokens(df.where("row_id < 4"), df.where("row_id >= 4"))
    vocab = py_vocab([py_pad(py_tokens(t)) for t in texts[:4]], None)
    assert [tuple(r) for r in p.vocab.orderBy("idx").collect()] == vocab
    index = {t: i for i, t, _ in vocab}
    got = {r["row_id"]: (r["X"], r["Y"]) for r in p.train.unionByName(p.test).collect()}
    names = {"World": 0, "Sports": 1, "Business": 2}
    want = {i: ([index.get(x, -1) for x in py_pad(py_tokens(t))], names.get(labels[i], -1))
            for i, t in enumerate(texts)}
    assert got == want
