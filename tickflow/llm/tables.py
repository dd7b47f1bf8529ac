"""Tables that operators write and read again between their steps."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tickflow.settings import scratch_path

BROADCAST_ROWS = 2_000_000
"""Rows of at most two 8-byte columns that may be broadcast: about 100 MB built."""


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def parts(rows: int, per_part: int) -> int:
    """Partitions for at most so many rows, by how many rows one may hold."""
    return 1 + rows // per_part


def settle(frame: DataFrame, name: str, partitions: int | None = None) -> DataFrame:
    """The rows as a table in the shared folder.

    Later steps read the files, so a lost executor costs no more than the task it ran, and
    nothing is computed twice. ``partitions`` gathers many small results into fewer files: every
    file costs its executor several calls to the file system, for some of which the local one
    starts a process that counts with the executor's memory.
    """
    path = scratch_path(frame.sparkSession, name)
    (frame if partitions is None else frame.coalesce(partitions)).write.parquet(path)
    return frame.sparkSession.read.schema(frame.schema).parquet(path)


def small(table: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """A settled table of narrow rows, marked for broadcast if its count allows it.

    The count comes from the files' footers. A larger table stays as it is and is joined by
    shuffling.
    """
    return F.broadcast(table) if table.count() <= rows else table


def free_names(frame: DataFrame, *names: str) -> list[str]:
    """The names, lengthened where the frame has such a column."""
    taken, found = {column.lower() for column in frame.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        taken.add(name.lower())
        found.append(name)
    return found


def least_hashed(rows: DataFrame, limit: int, key: str = "doc_id") -> DataFrame:
    """At most ``limit`` rows, those whose hashed key is least: a repeatable sample.

    Of many rows only about twice as many as needed are sorted, so that tasks do not send
    ``limit`` rows each.
    """
    order, total = F.xxhash64(key), rows.count()
    if total > 2 * limit:
        rows = rows.filter(order < int(2**64 * 2 * limit / total) - 2**63)
    return rows.orderBy(order, key).limit(limit)
