"""The trade job: raw trades in, metrics and alerts out. ``python -m tickflow.streaming.job``"""

from __future__ import annotations

import argparse
from collections.abc import Callable, Sequence
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickflow import schemas
from tickflow.operators.alerts import volatility
from tickflow.operators.messages import to_messages
from tickflow.operators.metrics import vwap
from tickflow.operators.parse import accepted, parse_trades, republish, unwrap
from tickflow.settings import Settings, build_session, checkpoint_path
from tickflow.sources.kafka import metrics_and_alerts, stream_messages
from tickflow.streaming import serving
from tickflow.streaming.sinks import await_any, start_console, start_kafka

Start = Callable[[DataFrame, str], StreamingQuery]


def results(messages: DataFrame, settings: Settings) -> tuple[DataFrame, DataFrame]:
    """(metrics, alerts) of a batch or stream of trade messages."""
    trades = parse_trades(messages)
    metrics = vwap(trades, settings.vwap_length, settings.vwap_slide, settings.delay)
    alerts = volatility(
        trades, settings.alert_length, settings.alert_threshold, settings.delay
    )
    return metrics, alerts


def kafka_starter(spark: SparkSession, settings: Settings, every: str | None = None) -> Start:
    """Starts the query that writes messages to a topic of the configured servers."""

    def start(messages: DataFrame, topic: str) -> StreamingQuery:
        checkpoint = checkpoint_path(spark, topic)
        return start_kafka(messages, settings.servers, topic, checkpoint, every=every)

    return start


def start_job(
    messages: DataFrame, start: Start, settings: Settings, console: bool = False
) -> list[StreamingQuery]:
    """Start the metric and alert queries on a stream of trade messages.

    ``start(messages, topic)`` starts one output query. ``console`` adds three queries that
    print raw messages and interim results; each reads and aggregates for itself, so leave
    it off where throughput counts.
    """
    metrics, alerts = results(messages, settings)
    queries = [
        start(to_messages(metrics), schemas.METRICS_TOPIC),
        start(to_messages(alerts), schemas.ALERTS_TOPIC),
    ]
    if console:
        for name, rows, mode in (
            ("messages", messages, "append"),
            ("metrics", metrics, "update"),
            ("alerts", alerts, "update"),
        ):
            checkpoint = checkpoint_path(messages.sparkSession, f"console-{name}")
            queries.append(start_console(rows, checkpoint, mode))
    return queries


def start_ingest(envelopes: DataFrame, start: Start) -> StreamingQuery:
    """Start republishing feed envelopes as raw-trade messages keyed by symbol."""
    return start(republish(accepted(unwrap(envelopes))), schemas.RAW_TOPIC)


def start_serving(
    metrics: DataFrame, alerts: DataFrame, path: str, every: str | None = None
) -> list[StreamingQuery]:
    """Start logging both result topics below ``path``, and showing each alert once there."""
    spark = metrics.sparkSession
    rows = {
        "metrics": serving.result_stream(metrics, schemas.METRIC),
        "alerts": serving.result_stream(alerts, schemas.ALERT),
    }
    every = every or schemas.REFRESH_INTERVAL
    queries = [
        serving.start_log(found, f"{path}/{name}", checkpoint_path(spark, f"log-{name}"), every)
        for name, found in rows.items()
    ]
    shown = rows["alerts"].drop("key", "offset")
    checkpoint = checkpoint_path(spark, "new-alerts")
    return [*queries, serving.start_new_alerts(shown, f"{path}/new-alerts", checkpoint, every)]


def compact_serving(spark: SparkSession, path: str, first: date, until: date) -> None:
    """Gather the days from ``first`` on and before ``until`` of both logs that ``start_serving``
    keeps below ``path`` in archives beside them; safe to run while it runs, by one at a time."""
    for name, result in (("metrics", schemas.METRIC), ("alerts", schemas.ALERT)):
        serving.compact_log(spark, f"{path}/{name}", f"{path}/{name}-archive", result, first, until)


def main(arguments: Sequence[str] | None = None) -> None:
    parser = argparse.ArgumentParser(description="Metrics and alerts from a topic of trades.")
    parser.add_argument(
        "part",
        nargs="?",
        default="metrics",
        choices=("metrics", "ingest", "serving", "compact"),
        help="trades to metrics and alerts, feed envelopes to trades, results to logs, or logs to archives",
    )
    parser.add_argument("--feed-topic", default="feed", help="envelopes that ingest reads")
    parser.add_argument("--path", help="folder that serving writes to")
    parser.add_argument("--since", type=date.fromisoformat, help="first day that compact gathers")
    parser.add_argument("--until", type=date.fromisoformat, help="the day after its last; today by default")
    parser.add_argument("--every", help="refresh interval, such as '5 seconds'")
    parser.add_argument("--starting", default="latest", help="where a first run begins")
    parser.add_argument("--max-messages", type=int, help="messages per refresh at most")
    parser.add_argument("--min-partitions", type=int, help="tasks per read at least")
    parser.add_argument("--console", action="store_true", help="print interim results too")
    chosen = parser.parse_args(arguments)
    if chosen.part in ("serving", "compact") and not chosen.path:
        parser.error(f"{chosen.part} needs --path")
    settings = Settings()
    spark = build_session("tickflow")
    if chosen.part == "compact":
        until = chosen.until or date.today()
        compact_serving(spark, chosen.path, chosen.since or until - timedelta(days=7), until)
        return
    options = {
        "starting": chosen.starting,
        "max_messages": chosen.max_messages,
        "min_partitions": chosen.min_partitions,
    }
    start = kafka_starter(spark, settings, chosen.every)
    if chosen.part == "serving":
        groups = {"metrics_group": settings.metrics_group, "alerts_group": settings.alerts_group}
        topics = metrics_and_alerts(spark, settings.servers, **groups, **options)
        start_serving(*topics, chosen.path, chosen.every)
    elif chosen.part == "ingest":
        start_ingest(stream_messages(spark, settings.servers, chosen.feed_topic, **options), start)
    else:
        messages = stream_messages(spark, settings.servers, **options)
        start_job(messages, start, settings, chosen.console)
    await_any(spark)


if __name__ == "__main__":
    main()
