"""Labelled CSV input.

``multiLine`` keeps newlines inside quoted fields; a doubled quote is a quote.
A multi-line CSV file is read by one task, so large inputs should arrive as
many files.  Row ids come from ``monotonically_increasing_id`` right after the
scan: unique and increasing within each file.  ``store_labelled_csv`` writes the
rows once and numbers them in file order, so later jobs see stable ids.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

# The columns of the headerless news CSV, in file order.
ARTICLE_SCHEMA = "indexed_label INT, title STRING, description STRING"
# Strings a CSV reader commonly treats as missing.
DEFAULT_NA_VALUES = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>",
    "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


#: Column of a stored CSV table with the text of a row that could not be read as the schema says.
RECORD = "_record"


def _reader(spark: SparkSession, header: bool, mode: str = "PERMISSIVE"):
    return (
        spark.read.option("header", header)
        .option("multiLine", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("mode", mode)
    )


def _null_na(df: DataFrame, na_values: Sequence[str] | None, skip: Sequence[str] = ()) -> DataFrame:
    if not na_values:
        return df
    na = list(na_values)
    cols = []
    for f in df.schema.fields:
        c = F.col(f.name)
        if f.dataType.simpleString() == "string" and f.name not in skip:
            c = F.when(c.isin(na), F.lit(None)).otherwise(c).alias(f.name)
        cols.append(c)
    return df.select(*cols)


def read_labelled_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str = ARTICLE_SCHEMA,
    header: bool = False,
    na_values: Sequence[str] | None = DEFAULT_NA_VALUES,
    row_col: str = "row_id",
    file_col: str | None = None,
) -> DataFrame:
    """Headerless (default) or headered CSV with an explicit schema, plus a row id.

    ``file_col`` adds the path of a row's file.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = _reader(spark, header).schema(schema).csv(paths)
    if file_col:
        df = df.select("*", F.col("_metadata.file_path").alias(file_col))
    df = _null_na(df, na_values, skip=(file_col,))
    return df.withColumn(row_col, F.monotonically_increasing_id())


def store_labelled_csv(
    spark: SparkSession, path: str | Sequence[str], out: str, schema: str = ARTICLE_SCHEMA,
    na_values: Sequence[str] | None = DEFAULT_NA_VALUES, row_col: str = "row_id",
) -> DataFrame:
    """Headerless CSV read once and written to ``out`` as parquet, read back with row ids
    0, 1, ... by file name, then position in the file.

    One task reads a file, so ids of a file's rows follow one another from its
    smallest; only one row per file is numbered by a window, and no text is shuffled.
    """
    df = read_labelled_csv(spark, path, schema, na_values=na_values, row_col=row_col, file_col="_file")
    df.write.parquet(out)
    raw = spark.read.parquet(out)
    files = raw.groupBy("_file").agg(F.min(row_col).alias("_first"), F.count(F.lit(1)).alias("_rows"))
    before = Window.orderBy("_file").rowsBetween(Window.unboundedPreceding, -1)
    files = files.select("_file", "_first", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_off"))
    return raw.join(files, "_file").withColumn(
        row_col, F.col(row_col) - F.col("_first") + F.col("_off")).drop("_file", "_first", "_off")


@dataclass
class CheckedCsv:
    """The rows of a CSV input that fit its schema, and those that do not."""

    good: DataFrame  # row id and the schema's columns
    rejected: DataFrame  # row id, file, record: the row's text (values of the wrong type: its fields again)
    row_col: str = "row_id"

    def report(self) -> DataFrame:
        """One row: ``n_rows, n_good, n_rejected`` and, of the good rows, ``null_<column>`` for each."""
        names = [c for c in self.good.columns if c != self.row_col]
        both = self.good.withColumn("_good", F.lit(True)).unionByName(
            self.rejected.select(self.row_col, F.lit(False).alias("_good")), allowMissingColumns=True)
        return both.agg(
            F.count(F.lit(1)).alias("n_rows"), F.count_if("_good").alias("n_good"),
            F.count_if(~F.col("_good")).alias("n_rejected"),
            *[F.count_if(F.col("_good") & F.col(f"`{c}`").isNull()).alias(f"null_{c}") for c in names])


def read_checked_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    out: str,
    schema: str = ARTICLE_SCHEMA,
    header: bool = False,
    mode: str = "PERMISSIVE",
    na_values: Sequence[str] | None = DEFAULT_NA_VALUES,
    row_col: str = "row_id",
) -> CheckedCsv:
    """Read CSV once, write it to ``out`` as parquet, and tell good rows from rejected ones.

    A row is rejected when it has more or fewer fields than the file has columns or a value that is not of
    its column's type; an open quote makes one rejected row of all that it swallows.  NA strings are
    missing values, not bad ones.  With a header, the schema's columns are taken by name.  ``mode``
    ``FAILFAST`` raises at the first bad row instead; ``DROPMALFORMED`` is refused, as it loses rows
    without a word.
    """
    if mode not in ("PERMISSIVE", "FAILFAST"):
        raise ValueError(f"mode is PERMISSIVE or FAILFAST, not {mode}")
    paths = [path] if isinstance(path, str) else list(path)
    wanted = StructType.fromDDL(schema)
    names = _reader(spark, True).csv(paths).columns if header else [f.name for f in wanted]
    if missing := [f.name for f in wanted if f.name not in names]:
        raise ValueError(f"columns not in the header: {missing}; it has {names}")
    # All fields as text first: a missing value is then told from one of the wrong type.
    text = StructType([StructField(c, StringType()) for c in names] + [StructField(RECORD, StringType())])
    raw = _reader(spark, header, mode).option("columnNameOfCorruptRecord", RECORD).option(
        "enforceSchema", not header).schema(text).csv(paths)
    raw = raw.select("*", F.col("_metadata.file_path").alias("_file"),
                     F.monotonically_increasing_id().alias(row_col))
    raw = _null_na(raw, na_values, skip=(RECORD, "_file"))
    typed = {f.name: F.col(f"`{f.name}`").try_cast(f.dataType) for f in wanted}
    wrong = F.lit(False)
    for f in wanted:
        wrong = wrong | (F.col(f"`{f.name}`").isNotNull() & typed[f.name].isNull())
    whole = F.to_csv(F.struct(*[F.col(f"`{c}`") for c in names]), {"quoteAll": "true", "escape": '"'})
    if mode == "FAILFAST":
        wrong = F.when(wrong, F.raise_error(F.concat(F.lit("malformed CSV row: "), whole)).cast("boolean")).otherwise(
            F.lit(False))
    record = F.coalesce(F.regexp_replace(RECORD, "\r?\n$", ""), F.when(wrong, whole))
    raw.select(row_col, "_file", record.alias(RECORD), *[v.alias(k) for k, v in typed.items()]).write.parquet(out)
    stored = spark.read.parquet(out)
    good = stored.where(F.col(RECORD).isNull()).select(row_col, *[f"`{f.name}`" for f in wanted])
    rejected = stored.where(F.col(RECORD).isNotNull()).select(
        row_col, F.col("_file").alias("file"), F.col(RECORD).alias("record"))
    return CheckedCsv(good, rejected, row_col)


def read_headered_csv(
    spark: SparkSession,
    path: str | Sequence[str],
    schema: str,
    na_values: Sequence[str] | None = DEFAULT_NA_VALUES,
    row_col: str = "row_id",
) -> DataFrame:
    """CSV with a header line; the columns of ``schema`` are taken by name.

    Other columns are ignored.  A missing column is an error, and so is a file
    whose header differs from the first file's.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = _reader(spark, True).option("enforceSchema", False).csv(paths)
    wanted = StructType.fromDDL(schema)
    missing = [f.name for f in wanted if f.name not in df.columns]
    if missing:
        raise ValueError(f"columns not in the header: {missing}; it has {df.columns}")
    df = _null_na(df.select(*[f"`{f.name}`" for f in wanted]), na_values)
    df = df.select(*[F.col(f"`{f.name}`").try_cast(f.dataType).alias(f.name) for f in wanted])
    return df.withColumn(row_col, F.monotonically_increasing_id())
