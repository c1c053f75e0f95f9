"""The latest values of a key, kept by the commits of a store.

    <root>/landing_identity/run=7-4f1c../bucket=12/

Keys are dealt to buckets by hash. A run adds one small folder per bucket it touches; a commit lists
the folders of every bucket, and of two rows of a key the one of the later run counts. So a lookup
opens the buckets of its keys and nothing else, and a run writes as much as it changes. A bucket
with many folders is merged into one when it is written next.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.schema import IDENTITY

# Folders of a bucket from which it is merged into one.
MOST_FOLDERS = 8


class Held(NamedTuple):
    """The run that wrote a part of a zone, and its folder."""

    run: int
    folder: str


Parts = dict[str, Held]


class Index(NamedTuple):
    name: str
    keys: tuple[str, ...]
    fields: str

    @property
    def values(self) -> list[str]:
        return T.StructType.fromDDL(self.fields).names

    @property
    def schema(self) -> T.StructType:
        keys = [T.StructField(k, T.StringType()) for k in self.keys]
        return T.StructType([*keys, *T.StructType.fromDDL(self.fields)])


# What a write decision and an upsert need to know of a stored record.
LANDING_IDENTITY = Index("landing_identity", tuple(IDENTITY), "file_path string, file_hash string, partition_date string")
TRANSFORMED_IDENTITY = Index("transformed_identity", tuple(IDENTITY), "partition_date string")
# Where the current object of a key lies, whoever wrote it.
LANDING_OBJECT = Index("landing_object", ("file_path",), "object_partition string, fetch_seq long, object_run long, object_folder string")


def bucket_of(index: Index, buckets: int) -> Column:
    return F.pmod(F.xxhash64(*index.keys), F.lit(buckets)).cast("int")


def _part(bucket: int, held: Held) -> str:
    return f"{bucket}@{held.folder}"


def folders(parts: Parts) -> dict[int, list[Held]]:
    found: dict[int, list[Held]] = {}
    for part, held in parts.items():
        found.setdefault(int(part.partition("@")[0]), []).append(held)
    return found


def touched(index: Index, wanted: DataFrame, buckets: int) -> set[int]:
    """The buckets of the keys in ``wanted``: at most one number per bucket comes to the driver."""
    return {r[0] for r in wanted.select(bucket_of(index, buckets).alias("b")).distinct().collect()}


def read(spark: SparkSession, root: str, index: Index, parts: Parts, wanted: set[int]) -> DataFrame:
    """All rows of the buckets ``wanted``, with the ``run`` that wrote them."""
    base = f"{root}/{index.name}"
    paths = [f"{base}/{held.folder}/bucket={b}" for b, each in folders(parts).items() if b in wanted for held in each]
    whole = T.StructType([*index.schema, T.StructField("run", T.StringType()), T.StructField("bucket", T.IntegerType())])
    if not paths:
        rows = spark.createDataFrame([], whole)
    else:
        rows = spark.read.schema(whole).option("basePath", base).parquet(*paths)
    return rows.withColumn("run", F.substring_index("run", "-", 1).cast("long")).drop("bucket")


def latest(index: Index, rows: DataFrame) -> DataFrame:
    found = rows.groupBy(*index.keys).agg(F.max_by(F.struct(*index.values), F.col("run")).alias("v"))
    return found.select(*index.keys, "v.*")


def find(spark: SparkSession, root: str, index: Index, parts: Parts, wanted: DataFrame, buckets: int) -> DataFrame:
    """The latest values of the keys in ``wanted`` that are known; the others have no row."""
    if not parts:
        return spark.createDataFrame([], index.schema)
    rows = read(spark, root, index, parts, touched(index, wanted, buckets))
    keys = wanted.select(*index.keys).distinct()
    return latest(index, rows.join(keys, list(index.keys), "left_semi"))


def post(spark: SparkSession, root: str, index: Index, parts: Parts, rows: DataFrame, run: Held, buckets: int) -> Parts:
    """Write ``rows`` (one per key) as the values of a run; returns the parts a commit then lists."""
    path = f"{root}/{index.name}/{run.folder}"
    mine = rows.select(*index.schema.names)
    full = {b for b, each in folders(parts).items() if len(each) >= MOST_FOLDERS}
    merged = full & touched(index, mine, buckets) if full else set()
    if merged:
        old = read(spark, root, index, parts, merged)
        mine = latest(index, old.unionByName(mine.withColumn("run", F.lit(run.run).cast("long"))))
    dealt = mine.withColumn("bucket", bucket_of(index, buckets)).hint("rebalance", F.col("bucket"))
    dealt.write.mode("overwrite").partitionBy("bucket").parquet(path)
    whole = T.StructType([*index.schema, T.StructField("bucket", T.IntegerType())])
    written = spark.read.schema(whole).parquet(path).select("bucket").distinct()
    kept = {p: held for p, held in parts.items() if int(p.partition("@")[0]) not in merged}
    return {**kept, **{_part(r[0], run): run for r in written.collect()}}
