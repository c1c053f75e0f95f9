"""Captured responses, the engine's input, from files or as a stream."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from doclake.schema import CAPTURE_SCHEMA
from doclake.sources.objects import read_exported


def read_captures(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    return spark.read.schema(CAPTURE_SCHEMA).format(fmt).load(path)


def captures_from_files(spark: SparkSession, metadata: DataFrame, root: str) -> DataFrame:
    """Captures whose payloads lie as single files under ``root``.

    ``metadata`` has the capture columns but for the payload, and ``file_path`` below the root. A
    capture without a file, as a 304 is, keeps a null payload.
    """
    files = read_exported(spark, root).withColumnRenamed("content", "payload")
    return metadata.join(files, "file_path", "left").select(*CAPTURE_SCHEMA.names)


def stream_captures(
    spark: SparkSession, path: str, fmt: str = "parquet", files_per_batch: int = 1000
) -> DataFrame:
    reader = spark.readStream.schema(CAPTURE_SCHEMA).option("maxFilesPerTrigger", files_per_batch)
    return reader.format(fmt).load(path)
