"""Small helpers of this subpackage."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.sources.scratch import shared_folder

# Rows for which a small step has a task and a file, at least.
TASK_ROWS = 4096


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(
    frame: DataFrame, purpose: str, rows: int | None = None, each: int = TASK_ROWS
) -> DataFrame:
    """The frame's rows, written once to the shared folder and read back.

    Later steps then neither compute it again nor depend on the executors that did.
    `rows` sizes the step, by its own rows or those it is made from: it gets a task and a
    file for `each` of them, but one per core at least and never more than it has
    partitions. Without it, a few rows are a file for each partition of their shuffle.
    """
    path = shared_folder(frame.sparkSession, purpose)
    if rows is not None:
        cores = frame.sparkSession.sparkContext.defaultParallelism
        frame = frame.coalesce(max(cores, -(-rows // each)))
    frame.write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def kind_of(frame: DataFrame, column: str) -> str:
    return frame.schema[column].dataType.simpleString()


def fold(doc_id: Column, parts: int) -> Column:
    """The remainder of crc32 over the id as text, by which rows are held out."""
    return F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(parts))


def small_batches(batches: Iterable[pa.RecordBatch], rows: int = 256) -> Iterator[pa.RecordBatch]:
    """The batches in slices: Python's copies of the texts are those of one slice at a time."""
    for batch in batches:
        for at in range(0, max(batch.num_rows, 1), rows):
            yield batch.slice(at, rows)


def sized_batches(
    batches: Iterable[pa.RecordBatch], column: str, size: int = 4 << 20
) -> Iterator[pa.RecordBatch]:
    """The batches in slices of rows whose texts in `column` start within the same `size` bytes."""
    for batch in batches:
        lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0)
        lengths = lengths.to_numpy(zero_copy_only=False).astype(np.int64)
        part = (np.cumsum(lengths) - lengths) // size
        cuts = (np.flatnonzero(np.diff(part)) + 1).tolist()
        for at, end in pairwise([0, *cuts, batch.num_rows]):
            yield batch.slice(at, end - at)


def unused(columns: Iterable[str], *names: str) -> list[str]:
    """The names, each with underscores before it until no column is called so."""
    taken = {column.lower() for column in columns}
    found = []
    for name in names:
        while name.lower() in taken:
            name = f"_{name}"
        taken.add(name.lower())
        found.append(name)
    return found
