"""Output: parquet for frames and vocabularies, CSV with a header for reports."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, MapType, StructType


def write_frame(df: DataFrame, path: str, mode: str = "errorifexists") -> str:
    """Parquet; array columns stay arrays."""
    df.write.mode(mode).parquet(path)
    return path


def write_vocab(vocab: DataFrame, path: str, mode: str = "errorifexists") -> str:
    vocab.select("idx", "term", "n").write.mode(mode).parquet(path)
    return path


def write_csv(df: DataFrame, path: str, mode: str = "errorifexists", header: bool = True) -> str:
    """CSV, with a header by default, and no index column; nested columns become JSON text.

    The folder is created by the writer.  Quotes are doubled, matching the
    reader's options, so text with quotes, commas and newlines reads back equal.
    """
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, (ArrayType, MapType, StructType)):
            cols.append(F.to_json(F.col(f.name)).alias(f.name))
        else:
            cols.append(F.col(f.name))
    (
        df.select(*cols)
        .write.mode(mode)
        .option("header", header)
        .option("quote", '"')
        .option("escape", '"')
        .option("emptyValue", '""')
        .option("ignoreLeadingWhiteSpace", False)
        .option("ignoreTrailingWhiteSpace", False)
        .csv(path)
    )
    return path
