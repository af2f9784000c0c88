"""Work on Arrow batches whose memory is bounded by the size of batches and slices."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

# Two tasks of an executor hold a few batches each, in the JVM and in Python.
BATCH_BYTES = "8m"

Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Return freed memory to the system: a worker outlives its task, and would keep the most it ever held."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def in_arrow(df: DataFrame, function: Callable[[Batches], Batches], schema) -> DataFrame:
    """`df.mapInArrow` with batches of about BATCH_BYTES, and freed memory given back at the end of a task.

    The size of batches is a setting of the session that is read when a plan runs, so it stays set there.
    """
    df.sparkSession.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Batches) -> Batches:
        yield from function(batches)
        give_back()

    return df.mapInArrow(run, schema)


def slices(batch: pa.RecordBatch, text: int, size: int) -> Iterator[pa.RecordBatch]:
    """Slices with about `size` bytes in column `text`, of one row at least."""
    lengths = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    group = np.cumsum(lengths, dtype=np.int64) // size
    cuts = [0, *(np.flatnonzero(np.diff(group)) + 1), len(lengths)]
    for start, stop in zip(cuts, cuts[1:], strict=False):
        if stop > start:
            yield batch.slice(start, stop - start)
