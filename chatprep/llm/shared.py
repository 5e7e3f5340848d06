"""Small helpers shared by the operators: written intermediate tables and the fold of a key."""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import checkpoint_dir


def materialize(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet under the cluster's checkpoint folder and read it back: the lineage is
    cut by a table that every executor can read, so a lost executor never repeats the work."""
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/tables/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._written = path
    return out


def release(*tables: DataFrame) -> None:
    """Delete tables of ``materialize`` whose last reader has been written itself."""
    for df in tables:
        sc = df.sparkSession.sparkContext
        path = sc._jvm.org.apache.hadoop.fs.Path(df._written)
        path.getFileSystem(sc._jsc.hadoopConfiguration()).delete(path, True)


def trimmed(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]):
    """``run`` for ``mapInArrow``, giving freed memory back to the system when a task ends: a worker process
    serves many tasks and would otherwise keep the largest one's memory beside the executor's heap."""
    def tidy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            try:
                ctypes.CDLL(None).malloc_trim(0)
            except (OSError, AttributeError):  # not every C library has it
                pass

    return tidy


def fold(key: Column) -> Column:
    """crc32 of the key as text, modulo 5; rows with remainder 0 are held out of all learning."""
    return F.coalesce(F.crc32(F.coalesce(key.cast("string"), F.lit("")).cast("binary")) % 5, F.lit(0))


def whole_groups(batches: Iterator[pa.RecordBatch], column: str, handle: Callable[[pa.Table], pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Apply ``handle`` to runs of whole groups of a stream sorted by ``column`` (a long); only the last
    group of a batch is held back, since it may go on in the next one."""
    held: pa.Table | None = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        table = pa.concat_tables([held, table]) if held is not None else table
        key = table.column(column).to_numpy()
        whole = int(np.searchsorted(key, key[-1]))
        held = table.slice(whole)
        if whole:
            yield handle(table.slice(0, whole).combine_chunks())
    if held is not None:
        yield handle(held.combine_chunks())
