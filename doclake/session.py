"""Session settings the jobs are written for. Nothing depends on them for its result."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

from pyspark.sql import SparkSession

SETTINGS = {
    # ISO strings of timestamps and dates are made in this zone.
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Above the advisory partition size, so that a join whose slim side fits in memory per
    # partition hashes that side instead of sorting the one with the content.
    "spark.sql.adaptive.maxShuffledHashJoinLocalMapThreshold": "128m",
    # The JVM does not compile methods above 8000 bytes of code. Long projections pass that limit
    # when fused; below it they are generated in pieces, which run compiled and twice as fast.
    "spark.sql.codegen.hugeMethodLimit": "8000",
    # Pages are large: bound an Arrow batch by bytes, not by rows alone.
    "spark.sql.execution.arrow.maxRecordsPerBatch": "2000",
    "spark.sql.execution.arrow.maxBytesPerBatch": "32m",
}

# For a cluster: start with many shuffle partitions and let the adaptive planner merge them.
CLUSTER_SETTINGS = {
    **SETTINGS,
    "spark.sql.adaptive.coalescePartitions.initialPartitionNum": "20000",
    "spark.sql.adaptive.advisoryPartitionSizeInBytes": "128m",
    "spark.sql.files.maxPartitionBytes": "256m",
}


_BATCHES = ("spark.sql.execution.arrow.maxRecordsPerBatch", "spark.sql.execution.arrow.maxBytesPerBatch")


def bound_batches(spark: SparkSession) -> None:
    """Bound the Arrow batches of pages, which a worker holds whole with what it makes of them."""
    for name in _BATCHES:
        spark.conf.set(name, SETTINGS[name])


@contextmanager
def compiled(spark: SparkSession) -> Iterator[None]:
    """Run the long projections of captures compiled, whatever the session's own method limit.

    A fused stage above the limit of the JVM is interpreted, at less than half the speed. The limit is
    read when a plan runs, so only jobs inside the block are bound by it.
    """
    name = "spark.sql.codegen.hugeMethodLimit"
    usual = spark.conf.get(name)
    spark.conf.set(name, SETTINGS[name])
    try:
        yield
    finally:
        spark.conf.set(name, usual)


def configure(spark: SparkSession, cluster: bool = False) -> SparkSession:
    for name, value in (CLUSTER_SETTINGS if cluster else SETTINGS).items():
        spark.conf.set(name, value)
    return spark
