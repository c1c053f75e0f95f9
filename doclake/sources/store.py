"""The two zones on shared storage, as plain Parquet folders.

    <root>/landing/run=7-4f1c../partition_date=2024-01-01/          metadata
    <root>/landing_objects/run=7-4f1c../partition_date=2024-01-01/  bytes, bucketed by key
    <root>/landing_identity/run=7-4f1c../bucket=12/                 indexes, see ``index``
    <root>/commits/run=7/                                           the folders that count

Every attempt of a run writes folders of its own, named after a random id. A commit, one small file
written last, lists the folders that are part of the zones: which one holds each metadata partition
and index bucket, and all that hold objects. Readers open only those, so what a dead attempt wrote is
never seen, not even if another run later commits the same number. Of two runs that began from one
state one commits, and the other is done again from what is then there. Only the metadata partitions a
run touches are rewritten, objects are only added.

Landing objects are bucketed by their key, the way Spark buckets tables: a join on the key moves the
other side to them and leaves the content where it is.
"""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable
from datetime import date
from functools import reduce

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from doclake.schema import LANDING_SCHEMA, TRANSFORMED_SCHEMA
from doclake.sources import index as indexes
from doclake.sources.index import LANDING_IDENTITY, LANDING_OBJECT, Held, Index, Parts
from doclake.sources.landing import iso
from doclake.sources.objects import ORDER, current_versions

METADATA = {
    "landing": T.StructType([*LANDING_SCHEMA.fields, T.StructField("object_partition", T.StringType())]),
    "transformed": TRANSFORMED_SCHEMA,
}
_OBJECT = T.StructType().add("file_path", "string").add("content", "binary")
_OBJECT = _OBJECT.add("content_type", "string").add("file_hash", "string")
OBJECTS = {
    "landing": T.StructType([*_OBJECT.fields]).add("fetch_seq", "long"),
    "transformed": T.StructType(
        [*_OBJECT.fields, *[f for f in TRANSFORMED_SCHEMA.fields if f.name not in _OBJECT.names]]
    )
    .add("unchanged_content", "boolean")
    .add("error_code", "string")
    .add("reason", "string"),
}
for _schema in OBJECTS.values():
    _schema.add("run", "long")
    if "partition_date" not in _schema.names:
        _schema.add("partition_date", "string")
_COMMIT = "zone string, part string, data_run long, folder string"
# What orders two writes of one key.
_ORDER = {
    "landing": ("run", "fetch_seq"),
    "transformed": ("run", "partition_date", "identifier", "body"),
}
_MARK = "mark:"
_LAYOUT = "layout"
# How often a run is done in all if others keep committing first.
ATTEMPTS = 5

Zones = dict[str, Parts]


class Conflict(RuntimeError):
    """Another run has committed since this one began."""


class Store:
    def __init__(self, spark: SparkSession, root: str, buckets: int | None = None) -> None:
        """``buckets`` (of objects and indexes) counts for a new store; a store keeps what it began with."""
        self.spark, self.root = spark, root.rstrip("/")
        self.new_buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))

    def state(self) -> tuple[int, Zones]:
        """(last committed run, zone -> partition -> who holds it). One row per partition and run."""
        run = self._last_commit()
        if run is None:
            return 0, {}
        zones: Zones = {}
        for row in self.spark.read.parquet(f"{self.root}/commits/run={run}").collect():
            zones.setdefault(row.zone, {})[row.part] = Held(row.data_run, row.folder)
        return run, zones

    def _last_commit(self) -> int | None:
        """Highest run whose commit is complete: one listing, however many runs there were."""
        hadoop = self.spark._jvm.org.apache.hadoop.fs
        folder = hadoop.Path(f"{self.root}/commits")
        files = folder.getFileSystem(self.spark._jsc.hadoopConfiguration())
        if not files.exists(folder):
            return None
        names = [entry.getPath().getName() for entry in files.listStatus(folder)]
        runs = [int(name.removeprefix("run=")) for name in names if name.startswith("run=")]
        for run in sorted(runs, reverse=True):
            if files.exists(hadoop.Path(folder, f"run={run}/_SUCCESS")):
                return run
        return None

    def _publish(self, pending: str, committed: str) -> None:
        """Rename a complete commit to its final name, which fails if there is one of that name.

        The rename is one step of the file system, so of two runs from one state only one succeeds.
        """
        hadoop, conf = self.spark._jvm.org.apache.hadoop.fs, self.spark._jsc.hadoopConfiguration()
        files = hadoop.Path(pending).getFileSystem(conf)
        source, target = (files.makeQualified(hadoop.Path(p)) for p in (pending, committed))
        context = hadoop.FileContext.getFileContext(source.toUri(), conf)
        plain = self.spark.sparkContext._gateway.new_array(getattr(hadoop, "Options$Rename"), 0)
        try:
            context.rename(source, target, plain)
        except Py4JJavaError:
            if not files.exists(target):
                raise
            files.delete(source, True)
            raise Conflict(f"{committed} is there already") from None

    def attempt(self, work: Callable[[Run], DataFrame], marks: dict[str, int] | None = None) -> DataFrame:
        """Do ``work`` in a run and commit it; if another run was faster, once more from the new state.

        A run that lost has written folders that no commit lists, so doing it again is all it takes.
        """
        for left in reversed(range(ATTEMPTS)):
            run = self.begin()
            result = work(run)
            try:
                run.commit(marks)
                return result
            except Conflict:
                if not left:
                    raise
        raise AssertionError

    def mark(self, name: str) -> int | None:
        """Number a stream committed last under this name."""
        held = self.state()[1].get(f"{_MARK}{name}", {}).get("")
        return held.run if held else None

    def begin(self) -> Run:
        return Run(self)

    def read(
        self, zone: str, start: date | str | None = None, end: date | str | None = None
    ) -> DataFrame:
        """A zone's metadata; with a range only the folders of that range are even listed."""
        partitions = self.state()[1].get(zone, {})
        inside = [
            d
            for d in partitions
            if (start is None or d >= iso(start)) and (end is None or d < iso(end))
        ]
        return self._folders(zone, {d: partitions[d] for d in inside})

    def _folders(self, zone: str, partitions: dict[str, Held]) -> DataFrame:
        schema = METADATA[zone]
        if not partitions:
            return self.spark.createDataFrame([], schema)
        paths = [f"{self.root}/{zone}/{h.folder}/partition_date={d}" for d, h in partitions.items()]
        reader = self.spark.read.schema(schema).option("basePath", f"{self.root}/{zone}")
        return reader.parquet(*paths).select(*schema.names)

    def objects(self, zone: str, records: DataFrame | None = None) -> DataFrame:
        """All object versions of committed runs, or those in the partitions ``records`` point to.

        The partitions are collected: one value per date window, never one per record.
        """
        versions = self._versions(zone)
        if "error_code" in versions.columns:
            versions = versions.where("error_code is null")
        if records is not None:
            used = [r[0] for r in records.select("object_partition").distinct().collect()]
            versions = versions.where(F.col("partition_date").isin(used))
        return versions.withColumn(ORDER, F.struct(*_ORDER[zone]))

    def _versions(self, zone: str) -> DataFrame:
        schema, base = OBJECTS[zone], f"{self.root}/{zone}_objects"
        folders = self.state()[1].get(f"{zone}_objects", {})
        if not folders:
            return self.spark.createDataFrame([], schema)
        named = T.StructType([f if f.name != "run" else T.StructField("run", T.StringType()) for f in schema])
        reader = self.spark.read.schema(named).option("basePath", base)
        versions = reader.parquet(*[f"{base}/{folder}" for folder in folders])
        return versions.withColumn("run", _run_number()).select(*schema.names)

    def objects_at(self, places: Iterable[tuple[str, str]], buckets: int) -> DataFrame:
        """Landing object versions in the (folder, partition) ``places``, one per run and date window.

        Read as the bucketed table they are written as, so that a join on file_path moves no content.
        """
        schema, base = OBJECTS["landing"], f"{self.root}/landing_objects"
        inside = [(F.col("run") == folder.removeprefix("run=")) & (F.col("partition_date") == day) for folder, day in places]
        if not inside:
            return self.spark.createDataFrame([], schema).withColumn(ORDER, F.struct(*_ORDER["landing"]))
        name = f"doclake_objects_{hashlib.md5(self.root.encode()).hexdigest()}"
        parts = ("run", "partition_date")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema if f.name not in parts)
        location = base.replace("\\", "\\\\").replace("'", "\\'")
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {name} ({columns}, run string, partition_date string) USING parquet "
            f"PARTITIONED BY (run, partition_date) CLUSTERED BY (file_path) SORTED BY (file_path) INTO {buckets} BUCKETS "
            f"LOCATION '{location}'"
        )
        if self.spark.conf.get("spark.sql.hive.manageFilesourcePartitions", "true") == "true":
            # The catalog knows only the partitions it is told of; no folder is listed for it.
            named = " ".join(f"PARTITION (run='{folder.removeprefix('run=')}', partition_date='{day}')" for folder, day in places)
            self.spark.sql(f"ALTER TABLE {name} ADD IF NOT EXISTS {named}")
        self.spark.catalog.refreshTable(name)
        rows = self.spark.table(name).where(reduce(Column.__or__, inside))
        return rows.withColumn("run", _run_number()).withColumn(ORDER, F.struct(*_ORDER["landing"]))


def _run_number() -> Column:
    return F.substring_index("run", "-", 1).cast("long")


class Run:
    """One write transaction from the state at its begin; its commit fails if that is no longer the last."""

    def __init__(self, store: Store) -> None:
        self.store = store
        last, self.zones = store.state()
        self.number = last + 1
        # Another attempt may take the same number; the folders are this one's own.
        self.folder = f"run={self.number}-{uuid.uuid4().hex}"
        layout = self.zones.setdefault(_LAYOUT, {"buckets": Held(store.new_buckets, "")})
        self.buckets = layout["buckets"].run

    def stage(self, name: str, rows: DataFrame) -> DataFrame:
        """Write a slim intermediate result and read it back; later steps start from the table."""
        path = f"{self.store.root}/staging/{self.folder}/{name}"
        rows.write.mode("overwrite").parquet(path)
        return rows.sparkSession.read.schema(rows.schema).parquet(path)

    def write_objects(self, zone: str, rows: DataFrame, dealt: bool = False) -> DataFrame:
        """Add object versions. Those of landing are moved to their buckets, unless they have been
        ``dealt`` to them; transformed ones are written where they are made."""
        path = f"{self.store.root}/{zone}_objects/{self.folder}"
        columns = [c for c in OBJECTS[zone].names if c != "run"]
        made = rows.select(*columns)
        if zone == "landing":
            # A writer of a bucketed table needs a name; the table is forgotten, its files stay.
            name = f"doclake_{uuid.uuid4().hex}"
            placed = made if dealt else made.repartition(self.buckets, "file_path")
            writer = placed.write.mode("append").partitionBy("partition_date")
            writer.bucketBy(self.buckets, "file_path").sortBy("file_path").option("path", path).format("parquet").saveAsTable(name)
            rows.sparkSession.sql(f"DROP TABLE {name}")
        else:
            made.write.mode("overwrite").partitionBy("partition_date").parquet(path)
        added = {**self.zones.get(f"{zone}_objects", {}), self.folder: Held(self.number, self.folder)}
        self.zones = {**self.zones, f"{zone}_objects": added}
        schema = T.StructType([f for f in OBJECTS[zone].fields if f.name != "run"])
        return rows.sparkSession.read.schema(schema).parquet(path)

    def find(self, index: Index, wanted: DataFrame) -> DataFrame:
        """The latest values of the keys in ``wanted``, from the touched buckets of the index."""
        self._build(index)
        return indexes.find(self.store.spark, self.store.root, index, self.zones.get(index.name, {}), wanted, self.buckets)

    def post(self, index: Index, rows: DataFrame) -> None:
        """Values of this run; ``rows`` has one row per key."""
        self._build(index)
        held, parts = Held(self.number, self.folder), self.zones.get(index.name, {})
        parts = indexes.post(self.store.spark, self.store.root, index, parts, rows, held, self.buckets)
        self.zones = {**self.zones, index.name: parts}

    def _build(self, index: Index) -> None:
        """Index a zone that was written before there were indexes, once, from the zone itself."""
        if index.name in self.zones:
            return
        if index == LANDING_OBJECT:
            if not self.zones.get("landing_objects"):
                return
            versions = self.store._versions("landing").withColumn(ORDER, F.struct(*_ORDER["landing"]))
            found = current_versions(versions, "partition_date", "fetch_seq", "run")
            names = F.create_map(*[F.lit(v) for h in self.zones["landing_objects"].values() for v in (h.run, h.folder)])
            rows = found.select(
                "file_path", F.col("partition_date").alias("object_partition"), "fetch_seq",
                F.col("run").alias("object_run"), names[F.col("run").cast("int")].alias("object_folder"),
            )
        else:
            zone = "landing" if index == LANDING_IDENTITY else "transformed"
            if not self.zones.get(zone):
                return
            rows = self.store._folders(zone, self.zones[zone])
        first = Held(0, f"run=0-{uuid.uuid4().hex}")
        parts = indexes.post(self.store.spark, self.store.root, index, {}, rows, first, self.buckets)
        self.zones = {**self.zones, index.name: parts}

    def merge(
        self,
        zone: str,
        records: DataFrame,
        held: DataFrame,
        combine: Callable[[DataFrame], DataFrame],
    ) -> None:
        """Rewrite the partitions that hold, or will hold, an identity of ``records``."""
        new = {r[0] for r in records.select("partition_date").distinct().collect()}
        old = {r[0] for r in held.select("partition_date").distinct().collect()}
        current = self.zones.get(zone, {})
        touched = {d: current[d] for d in (old | new) if d in current}
        merged = combine(self.store._folders(zone, touched))
        path = f"{self.store.root}/{zone}/{self.folder}"
        rows = merged.select(*METADATA[zone].names).hint("rebalance", F.col("partition_date"))
        rows.write.mode("overwrite").partitionBy("partition_date").parquet(path)
        kept = {d: held for d, held in current.items() if d not in touched}
        filled = merged.sparkSession.read.schema(METADATA[zone]).parquet(path)
        now = {r[0]: Held(self.number, self.folder) for r in filled.select("partition_date").distinct().collect()}
        self.zones = {**self.zones, zone: {**kept, **now}}

    def commit(self, marks: dict[str, int] | None = None) -> None:
        for name, number in (marks or {}).items():
            self.zones = {**self.zones, f"{_MARK}{name}": {"": Held(number, "")}}
        rows = [(zone, part, *held) for zone, parts in self.zones.items() for part, held in parts.items()]
        table = self.store.spark.createDataFrame(rows, _COMMIT).coalesce(1)
        pending = f"{self.store.root}/commits/_pending-{uuid.uuid4().hex}"
        table.write.parquet(pending)
        self.store._publish(pending, f"{self.store.root}/commits/run={self.number}")
