"""Assembled batches on disk with random access by (epoch, batch number).

Every task gets a run of consecutive batches in the order of (epoch, ``batch_seq``) and cuts it into files, so the
number of tasks does not follow the number of files, every file holds a run of consecutive batches,
and a directory tells the run of each file.  Batch ``k``, or a restart from it, reads the
directory and then only the files that hold what is asked for; nothing is listed or scanned besides.

The directory has one row per file and epoch (``batches_per_file`` batches on average), is written after the
batches, and names files relative to the store: a store can be moved, and one without a directory was
not finished.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BATCHES_PER_FILE = 4096
#: A task sorts and writes at most so many batches, however few go to a file.
BATCHES_PER_TASK = 4096


def write_batch_store(batches: DataFrame, path: str, n_batches: int,
                      batches_per_file: int = BATCHES_PER_FILE) -> str:
    """Write ``batches`` (``epoch, batch_seq, ...``), about ``batches_per_file`` to a file; return ``path``.

    A batch's place follows from its epoch's first number and the sizes of the epochs before, so the
    batches are neither sampled nor assembled twice.
    """
    if batches_per_file <= 0:
        raise ValueError("batches_per_file must be positive")
    base = path.rstrip("/")
    spark = batches.sparkSession
    files = max(1, -(-n_batches // batches_per_file))
    tasks = min(files, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-n_batches // BATCHES_PER_TASK)))
    run = -(-files // tasks) * batches_per_file  # a task's batches fill whole files
    # One row an epoch, from the keys alone.
    epochs = batches.groupBy("epoch").agg(
        F.min("batch_seq").alias("first"), F.max("batch_seq").alias("last")).sort("epoch").collect()
    start, place = 0, F.lit(0).cast("long")
    for e in epochs:
        place = F.when(F.col("epoch").eqNullSafe(F.lit(e["epoch"])), F.col("batch_seq") - e["first"] + start).otherwise(place)
        start += e["last"] - e["first"] + 1
    task = F.least(F.floor(place / F.lit(run)), F.lit(tasks - 1)).cast("int")
    batches.repartitionById(tasks, task).sortWithinPartitions("epoch", "batch_seq").write.option(
        "maxRecordsPerFile", batches_per_file).parquet(f"{base}/batches")
    stored = spark.read.schema(batches.schema).parquet(f"{base}/batches")
    stored.select("epoch", "batch_seq", F.col("_metadata.file_name").alias("file")).groupBy("epoch", "file").agg(
        F.min("batch_seq").alias("first"), F.max("batch_seq").alias("last"),
        F.count(F.lit(1)).alias("n")).sort("epoch", "first").write.parquet(f"{base}/directory")
    return path


def directory(spark: SparkSession, path: str) -> DataFrame:
    """``epoch, file, first, last, n``: the run of batches in each file."""
    return spark.read.parquet(f"{path.rstrip('/')}/directory")


def _files(spark: SparkSession, path: str, epoch: int, first: int, last: int | None) -> list[str]:
    """Files of an epoch's batches from ``first`` to ``last`` (None: to the end)."""
    runs = directory(spark, path).where((F.col("epoch") == epoch) & (F.col("last") >= first))
    if last is not None:
        runs = runs.where(F.col("first") <= last)
    return [f"{path.rstrip('/')}/batches/{r['file']}" for r in runs.select("file").distinct().collect()]


def read_batches(spark: SparkSession, path: str, epoch: int, first: int = 0,
                 last: int | None = None) -> DataFrame:
    """Batches ``first`` to ``last`` (None: to the end) of an epoch, by reading only their files.

    A restart from batch ``k`` is ``first=k``.  Batches that do not exist give no rows.
    """
    files = _files(spark, path, epoch, first, last)
    if not files:
        return spark.createDataFrame([], spark.read.parquet(f"{path.rstrip('/')}/batches").schema)
    schema = spark.read.parquet(files[0]).schema
    wanted = (F.col("epoch") == epoch) & (F.col("batch_seq") >= first)
    if last is not None:
        wanted = wanted & (F.col("batch_seq") <= last)
    return spark.read.schema(schema).parquet(*files).where(wanted)


def read_batch(spark: SparkSession, path: str, epoch: int, k: int) -> DataFrame:
    """Batch ``k`` of an epoch: one row, from one file."""
    return read_batches(spark, path, epoch, k, k)
