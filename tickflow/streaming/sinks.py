"""Where streams end: Kafka topics, files, the console, or several of these at once.

Each query has a checkpoint of its own and resumes from it. ``every`` is the refresh
interval; ``drain=True`` instead reads everything that is there and stops.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

BatchWriter = Callable[[DataFrame, int], None]


def _writer(
    rows: DataFrame,
    checkpoint: str | None,
    mode: str,
    every: str | None,
    drain: bool,
    name: str | None = None,
) -> DataStreamWriter:
    writer = rows.writeStream.outputMode(mode)
    if checkpoint is not None:
        writer = writer.option("checkpointLocation", checkpoint)
    if name is not None:
        writer = writer.queryName(name)
    if drain:
        return writer.trigger(availableNow=True)
    return writer if every is None else writer.trigger(processingTime=every)


def kafka_sink_options(
    servers: str, topic: str, extra: Mapping[str, str] | None = None
) -> dict[str, str]:
    options = {"kafka.bootstrap.servers": servers, "topic": topic}
    options.update({f"kafka.{name}": value for name, value in (extra or {}).items()})
    return options


def start_kafka(
    messages: DataFrame,
    servers: str,
    topic: str,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    extra: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Keyed messages to a topic. Delivery is at least once: readers keep the last per key."""
    writer = _writer(messages, checkpoint, mode, every, drain, topic).format("kafka")
    return writer.options(**kafka_sink_options(servers, topic, extra)).start()


def write_kafka(
    messages: DataFrame, servers: str, topic: str, extra: Mapping[str, str] | None = None
) -> None:
    """A finished batch of keyed messages to a topic."""
    writer = messages.write.format("kafka")
    writer.options(**kafka_sink_options(servers, topic, extra)).save()


def start_files(
    rows: DataFrame,
    path: str,
    checkpoint: str,
    every: str | None = None,
    drain: bool = False,
    partition_by: Sequence[str] = (),
    name: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> StreamingQuery:
    """Append rows to parquet files, each exactly once."""
    writer = _writer(rows, checkpoint, "append", every, drain, name).format("parquet")
    writer = writer.options(**(extra or {}))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    return writer.start(path)


def start_console(
    rows: DataFrame,
    checkpoint: str,
    mode: str = "update",
    every: str | None = None,
    drain: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Print what each refresh changed (``update``) or added (``append``)."""
    return _writer(rows, checkpoint, mode, every, drain, name).format("console").start()


def append_files(path: str) -> BatchWriter:
    """Batch writer to parquet; a batch that is run again replaces what it wrote before."""

    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")

    return write


def newest_batch(rows: DataFrame) -> DataFrame:
    """Of what ``append_files`` wrote, the newest batch: the result of ``complete`` mode.

    Older batches stay until someone removes them, so a reader never finds nothing, even
    while the next one is written.
    """
    newest = rows.agg(F.max("batch_id").alias("newest"))
    joined = rows.join(F.broadcast(newest), F.col("batch_id") == F.col("newest"))
    return joined.drop("batch_id", "newest")


def publish(servers: str, topic: str, extra: Mapping[str, str] | None = None) -> BatchWriter:
    """Batch writer of keyed messages to a topic."""

    def write(batch: DataFrame, batch_id: int) -> None:
        write_kafka(batch, servers, topic, extra)

    return write


def start_fan_out(
    rows: DataFrame,
    writers: Sequence[BatchWriter],
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """One query feeding several writers, so source and aggregation run once for all.

    Each refresh is persisted while the writers go over it and released afterwards.
    """

    def write_all(batch: DataFrame, batch_id: int) -> None:
        batch.persist()
        try:
            for write in writers:
                write(batch, batch_id)
        finally:
            batch.unpersist()

    return start_batches(rows, write_all, checkpoint, mode, every, drain, name)


def start_batches(
    rows: DataFrame,
    write: BatchWriter,
    checkpoint: str,
    mode: str = "append",
    every: str | None = None,
    drain: bool = False,
    name: str | None = None,
) -> StreamingQuery:
    """Hand each refresh to a batch writer."""
    return _writer(rows, checkpoint, mode, every, drain, name).foreachBatch(write).start()


def await_any(spark: SparkSession, timeout: float | None = None) -> bool | None:
    """Wait until some query of the session ends; a failed one raises its error."""
    if timeout is None:
        return spark.streams.awaitAnyTermination()
    return spark.streams.awaitAnyTermination(timeout)
