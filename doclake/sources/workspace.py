"""Where intermediate tables go: the shared folder the cluster names."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# The codec of tables of whole texts: a quarter smaller than the session's own on prose.
TEXTS = "zstd"


def workspace(spark: SparkSession, purpose: str) -> str:
    """A new, empty folder path under ``spark.checkpoint.dir``.

    A machine-local folder is used only when nothing is set and Spark itself runs on one machine.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if not root:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder every executor can reach")
        root = tempfile.mkdtemp(prefix="doclake-")
    return f"{root.rstrip('/')}/{purpose}-{uuid.uuid4().hex}"


def materialize(df: DataFrame, purpose: str, compression: str | None = None) -> DataFrame:
    """Write a result once and read it back, so that what follows does not redo the work.

    Unlike a cached block, the written table outlives the executors that made it, and stays on disk
    to the end of the job: one that holds whole texts is better written with ``TEXTS``.
    """
    path = workspace(df.sparkSession, purpose)
    (df.write.option("compression", compression) if compression else df.write).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
