"""Memory of the Python workers, which Spark keeps and gives the next task."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa
from pyspark.sql import SparkSession

BATCH_BYTES = 4 << 20
Work = Callable[[Iterator[pa.RecordBatch]], Iterator]


def small_batches(spark: SparkSession) -> None:
    """Has the session send rows to Python some megabytes at a time.

    Ten thousand whole texts at a time, Spark's default, are held several times over on either
    side. Which rows come together changes no result.
    """
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))


def give_back() -> None:
    """Gives the system what Arrow's pool holds of buffers that are no longer used."""
    pa.default_memory_pool().release_unused()


def lean(work: Work) -> Work:
    """A function for ``mapInArrow`` that gives back its memory when its task ends.

    Arrow keeps the buffers of a task's batches otherwise, in every worker of an executor, while
    other tasks, with and without Python, need the memory.
    """

    @wraps(work)
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator:
        try:
            yield from work(batches)
        finally:
            give_back()

    return run
