"""Session helpers: building a session, and where lineage cuts are written.

Checkpoints and scratch tables go to the shared folder named by the cluster in
``spark.checkpoint.dir``.  Only a local-mode session (tests, bench) without that
setting gets a fresh folder under the system temporary directory.
"""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession


def get_spark(
    master: str | None = None,
    app: str = "seqframe",
    shuffle_partitions: int | None = None,
    extra: dict[str, str] | None = None,
) -> SparkSession:
    """A session with AQE on and the UI off; settings a cluster already has are kept."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    conf = {
        "spark.ui.enabled": "false",
        "spark.ui.showConsoleProgress": "false",
        "spark.sql.adaptive.enabled": "true",
        "spark.sql.adaptive.coalescePartitions.enabled": "true",
        "spark.sql.adaptive.skewJoin.enabled": "true",
        "spark.sql.session.timeZone": "UTC",
    }
    if shuffle_partitions:
        conf["spark.sql.shuffle.partitions"] = str(shuffle_partitions)
    conf.update(extra or {})
    for k, v in conf.items():
        builder = builder.config(k, v)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the checkpoint folder, setting one only for local sessions without it."""
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    configured = sc.getConf().get("spark.checkpoint.dir", None)
    if not configured:
        if not re.match(r"local(\[|$)", sc.master):
            raise RuntimeError(
                "spark.checkpoint.dir is not set; a cluster needs a shared folder for checkpoints"
            )
        configured = tempfile.mkdtemp(prefix="seqframe-ckpt-")
    sc.setCheckpointDir(configured)
    return sc.getCheckpointDir()


def scratch_dir(spark: SparkSession, name: str) -> str:
    """A fresh, never reused folder for written tables, inside the checkpoint folder."""
    base = ensure_checkpoint_dir(spark)
    return os.path.join(base, f"scratch-{name}-{uuid.uuid4().hex}")


def store_table(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` once as a parquet table in the checkpoint folder and read it back.

    Cuts the lineage as ``materialize`` does, but columns are compressed and read one by one: for tables
    with a row per element, which a checkpoint would keep at their full width.
    """
    path = scratch_dir(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def materialize(df: DataFrame) -> DataFrame:
    """Write ``df`` once to the checkpoint folder and cut its lineage.

    Used at stage boundaries where several later jobs read the same derived
    table (as the preprocessing job's output is read by batching).
    """
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)
