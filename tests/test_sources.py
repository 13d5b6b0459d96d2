import os
import tempfile

import pytest

from seqframe.functions.labels import with_label_names
from seqframe.operators.vocab import build_vocab
from seqframe.sources import (
    csv,
    read_frame,
    read_headered_csv,
    read_labelled_csv,
    read_vocab,
    write_csv,
    write_frame,
    write_vocab,
)


def _tmp():
    return tempfile.mkdtemp(prefix="seqframe-test-")


def test_headerless_csv_with_quotes_newlines_backslash(spark):
    d = _tmp()
    path = os.path.join(d, "train.csv")
    with open(path, "w") as f:
        f.write('"3","T ""q""","Line one\nline two, \\x"\n')
        f.write('4,NA,\n')
    rows = read_labelled_csv(spark, path).orderBy("row_id").collect()
    assert rows[0]["indexed_label"] == 3
    assert rows[0]["title"] == 'T "q"'
    assert rows[0]["description"] == "Line one\nline two, \\x"
    assert rows[1]["title"] is None and rows[1]["description"] is None
    assert rows[0]["row_id"] < rows[1]["row_id"]
    named = with_label_names(read_labelled_csv(spark, path))
    assert sorted(r["label"] for r in named.collect()) == ["Business", "Sci/Tech"]


def test_csv_round_trip_with_arrays(spark):
    df = spark.createDataFrame(
        [(1, 'a "b", c\nd', [1, -1]), (2, "plain", [])], "id long, text string, X array<int>")
    out = write_csv(df, os.path.join(_tmp(), "out"))
    back = read_headered_csv(spark, out, "id long, text string, X string").orderBy("id").collect()
    assert back[0]["text"] == 'a "b", c\nd' and back[0]["X"] == "[1,-1]"
    assert back[1]["X"] == "[]"


def test_parquet_frames_and_vocab(spark):
    d = _tmp()
    df = spark.createDataFrame([(0, ["a", "b", "a"])], "row_id long, s array<string>")
    v = build_vocab(df, "s")
    write_vocab(v, os.path.join(d, "v"))
    write_frame(df, os.path.join(d, "f"))
    assert [tuple(r) for r in read_vocab(spark, os.path.join(d, "v")).orderBy("idx").collect()] == [
        (0, "a", 2), (1, "b", 1)]
    assert read_frame(spark, os.path.join(d, "f")).first()["s"] == ["a", "b", "a"]


def test_headered_csv_is_read_by_name(spark):
    import pytest

    path = os.path.join(_tmp(), "news.csv")
    with open(path, "w") as f:
        f.write("class,title,description\n3,t1,Sports\nxx,n/a,-nan\n")
    rows = read_headered_csv(spark, path, "description string, class int").orderBy("row_id").collect()
    assert [(r["description"], r["class"]) for r in rows] == [("Sports", 3), (None, None)]
    with pytest.raises(ValueError, match="text"):
        read_headered_csv(spark, path, "text string")


def test_stored_csv_rows_are_numbered_in_file_order(spark):
    from seqframe.sources.csv import store_labelled_csv

    d = _tmp()
    os.makedirs(os.path.join(d, "in"))
    for name, rows in (("a.csv", ["a0"]), ("b.csv", [f"b{i}" for i in range(50)]), ("c.csv", ["c0", "c1"])):
        with open(os.path.join(d, "in", name), "w") as f:
            f.writelines(f'{1 + i % 4},"{r}","  two\nlines "\n' for i, r in enumerate(rows))
    df = store_labelled_csv(spark, os.path.join(d, "in"), os.path.join(d, "out"))
    got = [(r["row_id"], r["title"]) for r in df.orderBy("row_id").collect()]
    assert got == list(enumerate(["a0"] + [f"b{i}" for i in range(50)] + ["c0", "c1"]))
    assert {r["description"] for r in df.collect()} == {"  two\nlines "}


BAD_CSV = '''1,"a","fine"
x,"b","wrong code"
2,"c","extra","field"
3,"d"
,"e","no code"
4,"f",NA
2,"g","line one
line two, ""quoted"""
'''


def test_checked_csv_keeps_and_counts_bad_rows(spark, tmp_path):
    (tmp_path / "in.csv").write_text(BAD_CSV + '1,"h","open quote\n3,"i","swallowed"\n')
    got = csv.read_checked_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"))
    assert [tuple(r)[1:] for r in got.good.orderBy("row_id").collect()] == [
        (1, "a", "fine"), (None, "e", "no code"), (4, "f", None), (2, "g", 'line one\nline two, "quoted"')]
    bad = [r["record"] for r in got.rejected.orderBy("row_id").collect()]
    assert bad[:3] == ['"x","b","wrong code"', '2,"c","extra","field"', '3,"d"']
    assert len(bad) == 4 and bad[3].startswith('1,"h","open quote') and "swallowed" in bad[3]
    assert got.report().first().asDict() == {
        "n_rows": 8, "n_good": 4, "n_rejected": 4, "null_indexed_label": 1, "null_title": 0,
        "null_description": 1}
    ids = [r["row_id"] for r in got.good.collect()] + [r["row_id"] for r in got.rejected.collect()]
    assert len(set(ids)) == 8


@pytest.mark.parametrize("line", ['x,"b","c"', '1,"b"', '1,"b","c","d"'])
def test_checked_csv_failfast(spark, tmp_path, line):
    (tmp_path / "in.csv").write_text('1,"a","fine"\n' + line + "\n")
    with pytest.raises(Exception, match="(?i)malformed"):
        csv.read_checked_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), mode="FAILFAST")
    with pytest.raises(ValueError, match="DROPMALFORMED"):
        csv.read_checked_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out2"), mode="DROPMALFORMED")


def test_checked_csv_with_header(spark, tmp_path):
    (tmp_path / "in.csv").write_text('k,text,n\n"a","t one",1\n"b","t two",many\n"c","t three"\n"d",,NA\n')
    got = csv.read_checked_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "out"), "n INT, text STRING",
                               header=True)
    assert [tuple(r)[1:] for r in got.good.orderBy("row_id").collect()] == [(1, "t one"), (None, None)]
    assert sorted(r["record"] for r in got.rejected.collect()) == ['"b","t two","many"', '"c","t three"']
    with pytest.raises(ValueError, match="other"):
        csv.read_checked_csv(spark, str(tmp_path / "in.csv"), str(tmp_path / "o2"), "other INT", header=True)
