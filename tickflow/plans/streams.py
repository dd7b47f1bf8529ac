"""Streaming queries over the given tables: each runs its stream to the end of the input
and returns what arrived at the sink."""

from __future__ import annotations

from collections.abc import Callable
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow import schemas
from tickflow.operators import alerts as al
from tickflow.operators import metrics as me
from tickflow.operators import parse as pa
from tickflow.operators import views as vi
from tickflow.operators.messages import to_messages
from tickflow.plans import tables
from tickflow.settings import scratch_path
from tickflow.sources.files import messages_from_files
from tickflow.streaming import serving, sinks, state

def _finish(query) -> None:
    query.awaitTermination()
    if query.exception() is not None:
        raise query.exception()


def _drain_to_files(rows: DataFrame, spark: SparkSession, name: str) -> DataFrame:
    base = scratch_path(spark, name)
    query = sinks.start_files(rows, f"{base}/rows", f"{base}/checkpoint", drain=True)
    _finish(query)
    return spark.read.schema(rows.schema).parquet(f"{base}/rows")


def _deliveries(rows: DataFrame, moment: str, path: str):
    """Append the rows in three deliveries, the month's first, second and last days.

    Each is written by as many tasks as the input has, and yields once it is there. A stream
    that is drained after each runs several refreshes and resumes from its checkpoint.
    """
    day = F.dayofmonth(moment)
    for part in (day <= 10, (day > 10) & (day <= 20), (day > 20) | day.isNull()):
        rows.filter(part).write.mode("append").parquet(path)
        yield


def _message_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_messages(tables.stream_events(spark, sf_dir))


def stream_vwap_append(spark, sf_dir):
    """Final metrics, from JSON messages: windows the watermark has passed."""
    trades = pa.parse_trades(_message_stream(spark, sf_dir))
    return _drain_to_files(me.vwap(trades, exact=True), spark, "vwap-append")


def stream_vwap_chained(spark, sf_dir):
    """Final metrics by two aggregations in a row, so that trades are not multiplied."""
    trades = pa.parse_trades(_message_stream(spark, sf_dir))
    return _drain_to_files(me.vwap(trades, exact=True, panes_first=True), spark, "vwap-chained")


def stream_open_windows(spark, sf_dir):
    """The windows still held after a restart at half of the input, read from the checkpoint."""
    messages = tables.event_messages(tables.read_table(spark, sf_dir, "events"))
    base = scratch_path(spark, "open-windows")
    for part in (F.dayofmonth("timestamp") <= 15, F.coalesce(F.dayofmonth("timestamp") > 15, F.lit(True))):
        messages.filter(part).write.mode("append").parquet(f"{base}/messages")
        feed = messages_from_files(spark, f"{base}/messages", True, schema=messages.schema)
        metrics = me.vwap(pa.parse_trades(feed), "30 minutes", "10 minutes", exact=True)
        _finish(sinks.start_files(metrics, f"{base}/rows", f"{base}/checkpoint", drain=True))
    return state.held_windows(spark, f"{base}/checkpoint")


def stream_bounded_refreshes(spark, sf_dir):
    """A backlog of uneven files in refreshes of bounded bytes: how many trades came of each symbol."""
    messages = tables.event_messages(tables.read_table(spark, sf_dir, "events"))
    base = scratch_path(spark, "bounded")
    messages.repartitionByRange(12, F.pow(F.dayofmonth("timestamp"), 3)).write.parquet(f"{base}/messages")
    feed = messages_from_files(spark, f"{base}/messages", True, schema=messages.schema, max_bytes=1 << 18)
    trades = _drain_to_files(pa.parse_trades(feed), spark, "bounded-rows")
    return trades.groupBy("symbol").agg(F.count("*").alias("trades"), F.countDistinct("offset").alias("distinct_trades"))


def _delivered_batches(
    spark: SparkSession, messages: DataFrame, moment: str, name: str, mode: str, step: Callable
) -> DataFrame:
    """Batches that ``step`` of a message stream writes over three deliveries of its input."""
    base = scratch_path(spark, name)
    for _ in _deliveries(messages, moment, f"{base}/messages"):
        feed = messages_from_files(spark, f"{base}/messages", True, schema=messages.schema)
        writers = [sinks.append_files(f"{base}/rows")]
        _finish(
            sinks.start_fan_out(step(feed), writers, f"{base}/checkpoint", mode=mode, drain=True)
        )
    return spark.read.parquet(f"{base}/rows")


def stream_vwap_update(spark, sf_dir):
    """Interim metrics of every refresh, the last per window and symbol kept."""
    messages = tables.event_messages(tables.read_table(spark, sf_dir, "events"))

    def metrics(feed: DataFrame) -> DataFrame:
        return me.vwap(pa.parse_trades(feed), "30 minutes", "10 minutes", exact=True)

    log = _delivered_batches(spark, messages, "timestamp", "vwap-update", "update", metrics)
    return vi.keep_last(log, "batch_id").drop("batch_id")


def stream_vwap_complete(spark, sf_dir):
    """All metrics so far, written anew by every refresh."""
    messages = tables.event_messages(tables.read_table(spark, sf_dir, "events"))

    def metrics(feed: DataFrame) -> DataFrame:
        return me.vwap(pa.parse_trades(feed), "1 hour", "1 hour", exact=True)

    log = _delivered_batches(spark, messages, "timestamp", "vwap-complete", "complete", metrics)
    return sinks.newest_batch(log)


_KINDS = ("click", "error", "purchase", "signup", "view")


def _metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hourly metrics as messages, with the time that deliveries go by."""
    trades = tables.event_trades(tables.read_table(spark, sf_dir, "events"))
    metrics = me.vwap(trades, "1 hour", "1 hour", exact=True)
    log = tables.result_messages(to_messages(metrics), F.lit(0).cast("bigint"))
    ends = F.get_json_object(F.col("value").cast("string"), "$.window_end")
    return log.withColumn("window_end", F.to_timestamp(ends))


def stream_pivot_complete(spark, sf_dir):
    """Metric messages to one volume column per symbol, written anew by every refresh."""

    def widened(feed: DataFrame) -> DataFrame:
        decoded = serving.result_stream(feed.drop("window_end"), schemas.METRIC)
        return vi.wide_series(decoded, "total_volume", _KINDS)

    log = _metric_log(spark, sf_dir)
    out = _delivered_batches(spark, log, "window_end", "pivot-complete", "complete", widened)
    return sinks.newest_batch(out)


def stream_pivot_append(spark, sf_dir):
    """The same rows, each given once when its window end is an hour behind the newest."""

    def widened(feed: DataFrame) -> DataFrame:
        decoded = serving.result_stream(feed.drop("window_end"), schemas.METRIC)
        return vi.wide_series(decoded, "total_volume", _KINDS, delay="1 hour")

    log = _metric_log(spark, sf_dir)
    out = _delivered_batches(spark, log, "window_end", "pivot-append", "append", widened)
    return out.drop("batch_id")


def stream_late_trades(spark, sf_dir):
    """Error events come after all others: late for every window the watermark has passed.

    The second run resumes the first one's state, from which those windows are gone.
    """
    messages = tables.event_messages(tables.read_table(spark, sf_dir, "events"))
    base, late = scratch_path(spark, "late-trades"), F.col("key") == F.lit("error").cast("binary")
    for part in (~late, late):
        messages.filter(part).write.mode("append").parquet(f"{base}/messages")
        feed = messages_from_files(spark, f"{base}/messages", True, schema=messages.schema)
        metrics = me.vwap(pa.parse_trades(feed), "30 minutes", "10 minutes", exact=True)
        _finish(sinks.start_files(metrics, f"{base}/rows", f"{base}/checkpoint", drain=True))
    return spark.read.schema(metrics.schema).parquet(f"{base}/rows")


def stream_alerts_append(spark, sf_dir):
    trades = pa.parse_trades(_message_stream(spark, sf_dir))
    return _drain_to_files(al.volatility(trades, "1 hour"), spark, "alerts-append")


def stream_raw_trades(spark, sf_dir):
    """Envelopes to keyed raw trades, read back from the sink."""
    envelopes = tables.event_envelopes(tables.stream_events(spark, sf_dir))
    messages = pa.republish(pa.accepted(pa.unwrap(envelopes)))
    written = _drain_to_files(messages, spark, "raw-trades")
    trade = F.from_json("value", schemas.RAW_TRADE)
    return written.select(
        "key",
        F.timestamp_millis(trade.getField("E")).alias("event_time"),
        trade.getField("p").cast("double").alias("price"),
        trade.getField("q").cast("double").alias("quantity"),
    )


def _shown_alerts(spark: SparkSession, sf_dir: str) -> str:
    """Where alerts are shown that come in three deliveries, newest days first, some twice."""
    trades = tables.event_trades(tables.read_table(spark, sf_dir, "events"))
    alerts = al.volatility(trades, "1 hour", order="event_time")
    log = tables.result_messages(to_messages(alerts), F.lit(0).cast("bigint"))
    base = scratch_path(spark, "new-alerts")
    end = F.get_json_object(F.col("value").cast("string"), "$.window_end")
    day = F.dayofmonth(end.cast("timestamp"))
    for part in (day > 20, day >= 1, (day > 10) & (day <= 20)):
        log.filter(part).write.mode("append").parquet(f"{base}/messages")
        feed = messages_from_files(spark, f"{base}/messages", True, schema=log.schema)
        decoded = serving.result_stream(feed, schemas.ALERT).drop("key", "offset")
        _finish(serving.start_new_alerts(decoded, f"{base}/out", f"{base}/checkpoint", drain=True))
    return f"{base}/out"


def stream_new_alerts(spark, sf_dir):
    """Alerts delivered out of order and more than once, each shown once."""
    return serving.read_shown(spark, _shown_alerts(spark, sf_dir)).drop("batch_id")


def stream_new_alert_counts(spark, sf_dir):
    """Per refresh how many alerts came and how many of them were new."""
    return serving.read_counts(spark, _shown_alerts(spark, sf_dir))


def stream_fan_out(spark, sf_dir):
    """One query, two sinks: metric rows and metric messages; the messages read back."""
    trades = pa.parse_trades(_message_stream(spark, sf_dir))
    base = scratch_path(spark, "fan-out")
    as_rows, as_messages = sinks.append_files(f"{base}/rows"), f"{base}/messages"

    def write_messages(batch: DataFrame, batch_id: int) -> None:
        sinks.append_files(as_messages)(to_messages(batch), batch_id)

    query = sinks.start_fan_out(
        me.vwap(trades, "30 minutes", "10 minutes", exact=True),
        [as_rows, write_messages],
        f"{base}/checkpoint",
        drain=True,
    )
    _finish(query)
    layout = "window_end TIMESTAMP, symbol STRING, vwap DOUBLE, total_volume DOUBLE"
    messages = spark.read.parquet(as_messages)
    return messages.select(F.from_json("value", layout).alias("v")).select("v.*")


def stream_results_log(spark, sf_dir):
    """Metric messages delivered twice with other values, logged by day, half of the days
    compacted, read back once per window."""
    trades = tables.event_trades(tables.read_table(spark, sf_dir, "events"))
    metrics = me.vwap(trades, "1 hour", "1 hour", exact=True)
    base = scratch_path(spark, "results-log")
    for delivery, values in enumerate((metrics.withColumn("vwap", F.lit(-1.0)), metrics)):
        arrival = F.lit(delivery).cast("bigint")
        log = tables.result_messages(to_messages(values), arrival)
        log.write.mode("append").parquet(f"{base}/messages")
    messages = messages_from_files(spark, f"{base}/messages", True, schema=log.schema)
    decoded = serving.result_stream(messages, schemas.METRIC)
    _finish(serving.start_log(decoded, f"{base}/log", f"{base}/checkpoint", drain=True))
    days = date(2024, 1, 1), date(2024, 1, 15)
    serving.compact_log(spark, f"{base}/log", f"{base}/archive", schemas.METRIC, *days)
    return serving.read_log(spark, f"{base}/log", schemas.METRIC, archive=f"{base}/archive")


def stream_to_latest(spark, sf_dir):
    """The whole way: envelopes, raw trades, metrics, log, latest metric per symbol."""
    base = scratch_path(spark, "to-latest")

    def through_files(rows: DataFrame, step: str, schema: T.StructType) -> DataFrame:
        """Run a step to its end and read its messages as a stream again."""
        path = f"{base}/{step}"
        _finish(sinks.start_files(rows, path, f"{path}-checkpoint", drain=True))
        stored = messages_from_files(spark, path, streaming=True, schema=schema)
        return tables.result_messages(stored, F.lit(0).cast("bigint"))

    envelopes = tables.event_envelopes(tables.stream_events(spark, sf_dir))
    raw = pa.republish(pa.accepted(pa.unwrap(envelopes)))
    trades = pa.parse_trades(through_files(raw, "raw", raw.schema))
    metrics = to_messages(me.vwap(trades, "30 minutes", "10 minutes", exact=True))
    sent = through_files(metrics, "metrics", metrics.schema)
    rows = serving.result_stream(sent, schemas.METRIC)
    _finish(serving.start_log(rows, f"{base}/log", f"{base}/log-checkpoint", drain=True))
    return vi.latest_rows(serving.read_log(spark, f"{base}/log", schemas.METRIC))


STREAMS = {
    query.__name__: query
    for query in (
        stream_vwap_append,
        stream_vwap_chained,
        stream_open_windows,
        stream_bounded_refreshes,
        stream_vwap_update,
        stream_vwap_complete,
        stream_pivot_complete,
        stream_pivot_append,
        stream_alerts_append,
        stream_raw_trades,
        stream_late_trades,
        stream_new_alerts,
        stream_new_alert_counts,
        stream_fan_out,
        stream_results_log,
        stream_to_latest,
    )
}
