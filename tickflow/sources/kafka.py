"""Kafka topics as DataFrames. The connector package must be on the session's classpath."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession

from tickflow import schemas


def kafka_options(
    servers: str,
    topic: str,
    starting: str = "latest",
    group_id: str | None = None,
    max_messages: int | None = None,
    min_partitions: int | None = None,
    min_messages: int | None = None,
    longest_wait: str | None = None,
    extra: Mapping[str, str] | None = None,
) -> dict[str, str]:
    """Reader options for one topic.

    ``max_messages`` bounds what one refresh reads; nothing is skipped, the rest comes with
    the next refresh. ``min_partitions`` splits a large topic partition over several tasks,
    so one hot symbol does not tie the read to one task. ``min_messages`` lets a refresh wait for so
    many, but no longer than ``longest_wait`` ("5m"). Progress is kept in the query's
    checkpoint, so no offsets are committed to the group.
    """
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": starting,
    }
    if group_id is not None:
        options["kafka.group.id"] = group_id
    if max_messages is not None:
        options["maxOffsetsPerTrigger"] = str(max_messages)
    if min_partitions is not None:
        options["minPartitions"] = str(min_partitions)
    if min_messages is not None:
        options["minOffsetsPerTrigger"] = str(min_messages)
    if longest_wait is not None:
        options["maxTriggerDelay"] = longest_wait
    options.update({f"kafka.{name}": value for name, value in (extra or {}).items()})
    return options


def stream_messages(
    spark: SparkSession, servers: str, topic: str = schemas.RAW_TOPIC, **options
) -> DataFrame:
    """Unbounded messages of a topic."""
    reader = spark.readStream.format("kafka")
    return reader.options(**kafka_options(servers, topic, **options)).load()


def read_messages(
    spark: SparkSession,
    servers: str,
    topic: str,
    starting: str = "earliest",
    ending: str = "latest",
    **options,
) -> DataFrame:
    """A bounded slice of a topic between two sets of offsets, as a batch DataFrame."""
    chosen = kafka_options(servers, topic, starting=starting, **options)
    # Batch reads take all of their offset range; a per-trigger bound does not apply.
    for name in ("maxOffsetsPerTrigger", "minOffsetsPerTrigger", "maxTriggerDelay"):
        chosen.pop(name, None)
    return (
        spark.read.format("kafka").options(**chosen).option("endingOffsets", ending).load()
    )


def metrics_and_alerts(
    spark: SparkSession,
    servers: str,
    max_messages: int | None = None,
    metrics_group: str | None = None,
    alerts_group: str | None = None,
    **options,
) -> tuple[DataFrame, DataFrame]:
    """The two result topics as streams: (metrics, alerts).

    ``max_messages`` bounds a refresh of each; without it a refresh reads all there is, so a
    reader cannot fall behind the topic's retention.
    """
    topics = {schemas.METRICS_TOPIC: metrics_group, schemas.ALERTS_TOPIC: alerts_group}
    metrics, alerts = (
        stream_messages(
            spark, servers, topic, group_id=group, max_messages=max_messages, **options
        )
        for topic, group in topics.items()
    )
    return metrics, alerts
