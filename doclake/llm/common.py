"""Shared by the corpus operators: tables, columns added by Arrow functions, running sums."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

import doclake

# The functions travel to the workers with their code: the package need not be installed there.
cloudpickle.register_pickle_by_value(doclake)

# A word is a run of anything but space and the control characters 9 to 13.
WORD = r"[^\x20\x09-\x0D]+"

# Bytes of text that a Python step gets at a time, whatever the size of Arrow's batches.
SLICE_BYTES = 2 << 20

# Bounds of an Arrow batch on its way: it is held by the JVM and by the Python worker at the same time,
# and rows carry whole texts.
BATCH_ROWS, BATCH_BYTES = 1000, 4 << 20

Step = Callable[..., list[pa.Array]]


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def free_name(df: DataFrame, stem: str) -> str:
    """A column name that no column of the frame has, in any case of letters."""
    taken = {c.lower() for c in df.columns}
    while stem.lower() in taken:
        stem += "_"
    return stem


def without(df: DataFrame, names: list[str]) -> list[str]:
    """The frame's columns but those that clash with ``names`` in any case of letters."""
    taken = {n.lower() for n in names}
    return [c for c in df.columns if c.lower() not in taken]


def add_columns(
    df: DataFrame, start: Callable[[], Step], fields: str, inputs: list[str], keep: list[str] | None = None
) -> DataFrame:
    """Add the columns of the DDL string ``fields``, computed batch by batch in Python.

    ``start`` runs once per task and returns the step that turns the input columns of a batch into
    the arrays of the new columns. Kept are the frame's columns (or ``keep`` of them); one whose
    name is that of a new column gives way to it. The session's Arrow batches are bounded for it.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    added = T.StructType.fromDDL(fields)
    kept = without(df.select(*[F.col(_quoted(c)) for c in (df.columns if keep is None else keep)]), added.names)
    read = list(dict.fromkeys([*kept, *inputs]))
    schema = T.StructType([*[df.schema[c] for c in kept], *added])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        step = start()
        for batch in (part for whole in batches for part in slices(whole)):
            made = step(*[batch.column(read.index(c)) for c in inputs])
            yield pa.RecordBatch.from_arrays([*[batch.column(read.index(c)) for c in kept], *made], names=schema.names)

    return df.select(*[F.col(_quoted(c)) for c in read]).mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows of about ``most`` bytes; a longer row is a run of its own."""
    if batch.nbytes <= most:
        yield batch
        return
    size = np.full(batch.num_rows, batch.nbytes // max(1, batch.num_rows))
    for each in batch.columns:
        if pa.types.is_string(each.type) or pa.types.is_binary(each.type):
            size = np.maximum(size, pc.binary_length(each).fill_null(0).to_numpy(zero_copy_only=False))
    run = (np.cumsum(size) - size) // most
    starts = [0, *(np.flatnonzero(np.diff(run)) + 1).tolist(), batch.num_rows]
    for start, end in zip(starts, starts[1:], strict=False):
        yield batch.slice(start, end - start)


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"


def column(name: str) -> Column:
    return F.col(_quoted(name))


def texts(column: pa.Array) -> Iterator[str]:
    """The strings of a batch, one at a time; null is the empty text."""
    for value in column:
        yield value.as_py() or ""


def held_out(doc_id: Column, folds: int, fold: int) -> Column:
    """Whether a document belongs to the fold by the checksum of its id; a null id never does."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % folds == fold, F.lit(False))
