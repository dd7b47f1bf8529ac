import datetime as dt

import pytest
from conftest import TRADE_DDL, at, ms, naive, rows_of
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.operators import alerts as al
from tickflow.operators import metrics as me
from tickflow.operators import parse as pa
from tickflow.operators import views as vi
from tickflow.operators.messages import to_messages
from tickflow.settings import Settings
from tickflow.sources import messages_from_files
from tickflow.streaming import serving, sinks
from tickflow.streaming.job import results, start_ingest, start_job


class Feed:
    """A folder that a stream reads one file per refresh, in the order of the calls."""

    def __init__(self, spark, path, schema):
        self.spark, self.path, self.schema = spark, str(path), schema

    def add(self, frame):
        frame.coalesce(1).write.mode("append").parquet(self.path)

    def stream(self):
        return messages_from_files(self.spark, self.path, True, 1, schema=self.schema)


@pytest.fixture
def trade_feed(spark, tmp_path):
    return Feed(spark, tmp_path / "trades", TRADE_DDL)


def drain(query):
    query.awaitTermination()
    assert query.exception() is None
    return query


def to_files(rows, tmp_path, name="out"):
    path = str(tmp_path / name)
    query = sinks.start_files(rows, path, str(tmp_path / f"{name}-checkpoint"), drain=True)
    drain(query)
    return rows.sparkSession.read.schema(rows.schema).parquet(path), query


def test_append_holds_back_open_windows(trade_feed, trades, tmp_path):
    rows = [("A", i, 10.0, 1.0) for i in range(0, 200, 5)]
    trade_feed.add(trades(*rows))
    out, _ = to_files(me.vwap(trade_feed.stream()), tmp_path)
    batch = me.vwap(trades(*rows)).filter(F.col("window_end") <= F.lit(at(195 - 60)))
    assert sorted(rows_of(out)) == sorted(rows_of(batch)) != []


def test_late_trades_are_merged_then_dropped(trade_feed, trades, tmp_path):
    """The refresh after a watermark jump still drops by the watermark before the jump."""
    trade_feed.add(trades(("A", 5, 1.0, 1.0)))
    trade_feed.add(trades(("A", 200, 1.0, 1.0)))
    trade_feed.add(trades(("A", 6, 1.0, 10.0)))
    trade_feed.add(trades(("A", 7, 1.0, 100.0)))
    trade_feed.add(trades(("A", 400, 1.0, 1.0)))
    out, query = to_files(me.volume(trade_feed.stream()), tmp_path)
    totals = dict(rows_of(out, "window_end", "total_volume"))
    assert totals == {naive(at(10)): 11.0, naive(at(210)): 1.0}
    dropped = sum(
        state.numRowsDroppedByWatermark
        for progress in query.recentProgress
        for state in progress.stateOperators
    )
    assert dropped == 1


def test_late_trades_within_the_delay_count(trade_feed, trades, tmp_path):
    trade_feed.add(trades(("A", 50, 1.0, 1.0)))
    trade_feed.add(trades(("A", 5, 1.0, 10.0)))
    trade_feed.add(trades(("A", 400, 1.0, 1.0)))
    out, _ = to_files(me.volume(trade_feed.stream()), tmp_path)
    totals = dict(rows_of(out, "window_end", "total_volume"))
    assert totals == {naive(at(10)): 10.0, naive(at(60)): 1.0}


STORES = "org.apache.spark.sql.execution.streaming.state."


@pytest.mark.parametrize("store", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_restart_resumes_from_the_checkpoint(spark, trade_feed, trades, tmp_path, store):
    name = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name)
    spark.conf.set(name, STORES + store)
    try:
        check_restart(trade_feed, trades, tmp_path)
    finally:
        spark.conf.set(name, before)


def check_restart(trade_feed, trades, tmp_path):
    first = [("A", i, float(i), 1.0) for i in range(0, 100, 3)]
    second = [("A", i, float(i), 1.0) for i in range(100, 300, 3)]
    trade_feed.add(trades(*first))
    to_files(me.vwap(trade_feed.stream()), tmp_path)
    trade_feed.add(trades(*second))
    out, query = to_files(me.vwap(trade_feed.stream()), tmp_path)
    assert sum(p.numInputRows for p in query.recentProgress) == len(second)
    last = second[-1][1]
    batch = me.vwap(trades(*first, *second)).filter(F.col("window_end") <= F.lit(at(last - 60)))
    assert sorted(rows_of(out)) == sorted(rows_of(batch))


def test_update_mode_ends_where_batch_does(spark, trade_feed, trades, tmp_path):
    rows = [("AB"[i % 2], i * 7 % 120, float(i), 1.0) for i in range(60)]
    for part in (rows[:20], rows[20:40], rows[40:]):
        trade_feed.add(trades(*part))
    path = str(tmp_path / "log")
    metrics = me.vwap(trade_feed.stream(), delay="1 hour")
    drain(
        sinks.start_fan_out(
            metrics, [sinks.append_files(path)], str(tmp_path / "c"), "update", drain=True
        )
    )
    log = spark.read.parquet(path)
    final = vi.keep_last(log, "batch_id").drop("batch_id")
    assert log.count() > final.count()
    assert sorted(rows_of(final)) == sorted(rows_of(me.vwap(trades(*rows))))


def test_interim_alerts_can_disagree_with_final_ones(spark, trade_feed, trades, tmp_path):
    trade_feed.add(trades(("A", 1, 100.0, 1.0, 1), ("A", 2, 110.0, 1.0, 2)))
    trade_feed.add(trades(("A", 3, 100.0, 1.0, 3)))
    trade_feed.add(trades(("B", 500, 100.0, 1.0, 4)))
    path = str(tmp_path / "interim")
    alerts = al.volatility(trade_feed.stream())
    drain(
        sinks.start_fan_out(
            alerts, [sinks.append_files(path)], str(tmp_path / "c"), "update", drain=True
        )
    )
    assert rows_of(spark.read.parquet(path), "symbol", "percent_change") == [("A", 10.0)]
    final, _ = to_files(al.volatility(trade_feed.stream()), tmp_path)
    assert final.count() == 0


@pytest.mark.parametrize("order", ["arrival", "event_time"])
def test_stream_alerts_equal_batch(trade_feed, trades, tmp_path, order):
    rows = [("AB"[i % 2], i * 11 % 90, 50.0 + i * 17 % 13, 1.0, i) for i in range(80)]
    rows.append(("Z", 900, 1.0, 1.0, 1000))
    trade_feed.add(trades(*rows))
    out, _ = to_files(al.volatility(trade_feed.stream(), order=order), tmp_path)
    assert sorted(rows_of(out)) == sorted(rows_of(al.volatility(trades(*rows), order=order))) != []


def test_a_rerun_batch_replaces_its_files(spark, tmp_path):
    write = sinks.append_files(str(tmp_path / "rows"))
    write(spark.range(5), 0)
    write(spark.range(3), 1)
    write(spark.range(3), 1)
    assert spark.read.parquet(str(tmp_path / "rows")).count() == 8


def test_fan_out_reads_the_source_once(trade_feed, trades, tmp_path):
    trade_feed.add(trades(*(("A", i, 1.0, 1.0) for i in range(100))))
    seen = {"a": 0, "b": 0}

    def count_into(name):
        def write(batch, batch_id):
            seen[name] += batch.count()

        return write

    query = sinks.start_fan_out(
        trade_feed.stream(), [count_into("a"), count_into("b")], str(tmp_path / "c"), drain=True
    )
    drain(query)
    assert seen == {"a": 100, "b": 100}
    assert sum(p.numInputRows for p in query.recentProgress) == 100


def test_console_modes(trade_feed, trades, tmp_path):
    trade_feed.add(trades(("A", 1, 1.0, 1.0)))
    for rows, mode in ((trade_feed.stream(), "append"), (me.vwap(trade_feed.stream()), "update")):
        query = drain(sinks.start_console(rows, str(tmp_path / mode), mode, drain=True))
        assert "Console" in query.lastProgress.sink.description
        assert sum(p.numInputRows for p in query.recentProgress) == 1


def test_refresh_interval(trade_feed, trades, tmp_path):
    trade_feed.spark.streams.resetTerminated()
    trade_feed.add(trades(("A", 1, 1.0, 1.0)))
    query = sinks.start_files(
        trade_feed.stream(), str(tmp_path / "o"), str(tmp_path / "c"), every="100 milliseconds"
    )
    try:
        query.processAllAvailable()
        assert not sinks.await_any(trade_feed.spark, timeout=0.5)
        assert query.isActive
    finally:
        query.stop()
        trade_feed.spark.streams.resetTerminated()


def test_a_failed_query_ends_the_wait(trade_feed, trades, tmp_path):
    trade_feed.add(trades(("A", 1, 1.0, 1.0)))

    trade_feed.spark.streams.resetTerminated()

    def fail(batch, batch_id):
        raise RuntimeError("sink is gone")

    sinks.start_fan_out(trade_feed.stream(), [fail], str(tmp_path / "c"), drain=True)
    try:
        with pytest.raises(Exception, match="sink is gone"):
            sinks.await_any(trade_feed.spark, timeout=60)
    finally:
        trade_feed.spark.streams.resetTerminated()


def alert_log(spark, *rows):
    full = [(None, at(end), symbol, 1.0, 2.0, 100.0) for end, symbol in rows]
    alerts = spark.createDataFrame(
        full,
        "window_start TIMESTAMP, window_end TIMESTAMP, symbol STRING, first_price DOUBLE, "
        "last_price DOUBLE, percent_change DOUBLE",
    )
    return to_messages(alerts).select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        F.monotonically_increasing_id().alias("offset"),
    )


def test_new_alerts_are_shown_once_however_late(spark, tmp_path):
    feed = Feed(spark, tmp_path / "alerts", "key BINARY, value BINARY, offset BIGINT")
    day = 86_400
    feed.add(alert_log(spark, (day, "A"), (day + 10, "A"), (day + 10, "B")))
    feed.add(alert_log(spark, (day + 10, "A"), (day + 10, "A"), (day + 10, "B")))
    path, checkpoint = str(tmp_path / "out"), str(tmp_path / "c")

    def run():
        decoded = serving.result_stream(feed.stream(), schemas.ALERT).drop("key", "offset")
        drain(serving.start_new_alerts(decoded, path, checkpoint, drain=True))

    run()
    # Far behind any watermark, and without a window end; then all of it again.
    feed.add(alert_log(spark, (10, "B"), (20, "B")))
    feed.add(alert_log(spark, (10, "B"), (day + 10, "B"), (30, "C")))
    run()
    shown = serving.read_shown(spark, path)
    assert sorted(rows_of(shown, "batch_id", "window_end", "symbol")) == [
        (0, naive(at(day)), "A"), (0, naive(at(day + 10)), "A"), (0, naive(at(day + 10)), "B"),
        (2, naive(at(10)), "B"), (2, naive(at(20)), "B"), (3, naive(at(30)), "C"),
    ]
    counts = serving.read_counts(spark, path)
    assert sorted(rows_of(counts, "batch_id", "records", "new_alerts")) == [
        (0, 3, 3), (1, 3, 0), (2, 2, 2), (3, 3, 1),
    ]


def test_alerts_without_a_window_are_shown_once(spark, tmp_path):
    layout = "window_end TIMESTAMP, symbol STRING"
    feed = Feed(spark, tmp_path / "alerts", layout)
    for _ in range(2):
        feed.add(spark.createDataFrame([(None, "A"), (None, None)], layout))
    path = str(tmp_path / "out")
    drain(serving.start_new_alerts(feed.stream(), path, str(tmp_path / "c"), drain=True))
    assert sorted(rows_of(serving.read_counts(spark, path), "batch_id", "new_alerts")) == [(0, 2), (1, 0)]


def test_a_time_in_another_unit_moves_no_watermark(spark, messages, tmp_path):
    def trade(seconds, factor=1, price="1"):
        return {"E": ms(seconds) * factor, "s": "A", "p": price, "q": "1"}

    first = messages(trade(1), trade(2, factor=1000), trade(3, price="NaN"))
    feed = Feed(spark, tmp_path / "raw", first.schema)
    for batch in (first, messages(trade(4)), messages(trade(5)), messages(trade(300))):
        feed.add(batch)
    trades = pa.parse_trades(feed.stream())
    out, _ = to_files(me.vwap(trades, "10 seconds", "10 seconds"), tmp_path)
    assert rows_of(out, "vwap", "total_volume") == [(3 / 4, 4.0)]


def test_result_stream_types_metrics(spark, messages):
    log = messages(
        {"window_end": "2024-01-01T00:00:10.000Z", "symbol": "A", "total_volume": 2.5},
        {"window_end": "soon", "symbol": "A", "vwap": "abc"},
        keys=["A", "A"],
    )
    typed = serving.result_stream(log, schemas.METRIC)
    assert rows_of(typed, *schemas.METRIC_COLUMNS, "offset") == [
        (naive(at(10)), "A", None, 2.5, 0),
        (None, "A", None, None, 1),
    ]


def test_log_keeps_the_last_delivery(spark, messages, tmp_path):
    def metric(day, vwap):
        return {"window_end": f"2024-01-0{day}T00:00:10Z", "symbol": "A", "vwap": vwap}

    batch = messages(
        metric(1, 1.0), metric(2, 2.0), metric(1, 3.0), {"symbol": "A"}, keys=["A"] * 4
    )
    feed = Feed(spark, tmp_path / "metrics", batch.schema)
    feed.add(batch)
    path, checkpoint = str(tmp_path / "log"), str(tmp_path / "c")
    rows = serving.result_stream(feed.stream(), schemas.METRIC)
    drain(serving.start_log(rows, path, checkpoint, drain=True))
    whole = serving.read_log(spark, path, schemas.METRIC)
    assert sorted(rows_of(whole, "vwap"), key=str) == [(2.0,), (3.0,), (None,)]
    recent = serving.read_log(spark, path, schemas.METRIC, dt.date(2024, 1, 2))
    assert rows_of(recent, "vwap") == [(2.0,)]
    assert "PartitionFilters: [isnotnull(day" in recent._jdf.queryExecution().toString()


def test_compacted_days_and_late_deliveries(spark, messages, tmp_path):
    def metric(day, vwap, symbol="A"):
        return {"window_end": f"2024-01-0{day}T00:00:10Z", "symbol": symbol, "vwap": vwap}

    first = messages(metric(1, 1.0), metric(1, 2.0), metric(2, 5.0), metric(3, 7.0))
    feed = Feed(spark, tmp_path / "metrics", first.schema)
    path, checkpoint, archive = (str(tmp_path / name) for name in ("log", "c", "archive"))

    def deliver(batch):
        feed.add(batch)
        rows = serving.result_stream(feed.stream(), schemas.METRIC)
        drain(serving.start_log(rows, path, checkpoint, drain=True, retention="7d"))

    def vwaps(**options):
        return sorted(rows_of(serving.read_log(spark, path, schemas.METRIC, **options), "vwap"))

    deliver(first)
    days = dt.date(2024, 1, 1), dt.date(2024, 1, 3)
    serving.compact_log(spark, path, archive, schemas.METRIC, *days)
    assert rows_of(spark.read.parquet(archive).orderBy("vwap"), "vwap") == [(2.0,), (5.0,)]
    assert vwaps(archive=archive) == vwaps() == [(2.0,), (5.0,), (7.0,)]
    late = messages(*[metric(9, 0.0, "Z")] * 4, metric(1, 3.0)).filter("offset = 4")
    deliver(late)
    assert vwaps(archive=archive) == [(3.0,), (5.0,), (7.0,)]
    serving.compact_log(spark, path, archive, schemas.METRIC, *days)
    assert vwaps(archive=archive) == vwaps() == [(3.0,), (5.0,), (7.0,)]
    assert vwaps(archive=archive, since=dt.date(2024, 1, 2)) == [(5.0,), (7.0,)]


def test_a_log_may_be_empty(spark, messages, tmp_path):
    batch = messages("not json")
    feed = Feed(spark, tmp_path / "metrics", batch.schema)
    feed.add(batch)
    for result in (schemas.METRIC, schemas.ALERT):
        path = str(tmp_path / "-".join(result.fieldNames()))
        rows = serving.result_stream(feed.stream(), result)
        drain(serving.start_log(rows, path, f"{path}-checkpoint", drain=True))
        log = serving.read_log(spark, path, result)
        assert log.schema == result and log.isEmpty()


def test_display_shows_new_alerts_once(spark, trades):
    rows = trades(*(("AB"[i % 2], i * 3, 100.0 + i * 7 % 19, 1.0) for i in range(40)))
    metrics, alerts = me.vwap(rows), al.volatility(rows)
    first = serving.display(metrics, alerts, alerts.filter("false"))
    second = serving.display(metrics, alerts, first["seen"])
    total = alerts.count()
    assert rows_of(first["alert_count"]) == rows_of(first["new_alert_count"]) == [(total,)]
    assert first["new_alert_lines"].count() == total > 0
    assert rows_of(second["new_alert_count"]) == [(0,)]
    assert rows_of(first["latest_rows"], "symbol") == [("A",), ("B",)]
    assert first["vwap_series"].columns == ["window_end", "A", "B"]
    ends = rows_of(first["volume_series"], "window_end")
    assert ends == sorted(ends)


def test_refresh_reads_its_inputs_once(spark, trades):
    rows = trades(*(("AB"[i % 2], i * 3, 100.0 + i * 7 % 19, 1.0) for i in range(40)))
    metrics, alerts = me.vwap(rows), al.volatility(rows)
    with serving.refresh(metrics, alerts, alerts.filter("false")) as views:
        for name in ("latest_rows", "vwap_series", "metric_count", "new_alert_lines"):
            assert "InMemoryTableScan" in views[name]._jdf.queryExecution().executedPlan().toString()
            assert not views[name].isEmpty()
    assert not metrics.storageLevel.useMemory and not alerts.storageLevel.useMemory


def test_serving_logs_and_shows(spark, tmp_path, monkeypatch):
    from tickflow.streaming import job

    monkeypatch.setattr(job, "checkpoint_path", lambda spark, name: f"{tmp_path}/c/{name}")
    batch = alert_log(spark, (10, "A"), (20, "B"))
    feed = Feed(spark, tmp_path / "alerts", batch.schema)
    feed.add(batch)
    queries = job.start_serving(feed.stream(), feed.stream(), f"{tmp_path}/out", every="100 milliseconds")
    try:
        for query in queries:
            query.processAllAvailable()
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()
    assert serving.read_log(spark, f"{tmp_path}/out/alerts", schemas.ALERT).count() == 2
    assert serving.read_shown(spark, f"{tmp_path}/out/new-alerts").count() == 2


def raw_messages(spark, rows):
    """Kafka-shaped trade messages from (symbol, seconds, price, quantity)."""
    frame = spark.createDataFrame(
        [(ms(t), s, str(p), str(q), i) for i, (s, t, p, q) in enumerate(rows)],
        "E BIGINT, s STRING, p STRING, q STRING, offset BIGINT",
    )
    return frame.select(
        F.col("s").cast("binary").alias("key"),
        F.to_json(F.struct("E", "s", "p", "q")).cast("binary").alias("value"),
        F.lit("raw_trades").alias("topic"),
        F.lit(0).alias("partition"),
        "offset",
        F.timestamp_millis("E").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def test_job_writes_both_result_topics(spark, tmp_path):
    rows = [("AB"[i % 2], i * 2, 100.0 + i * 7 % 19, 1.0 + i % 3) for i in range(100)]
    batch = raw_messages(spark, rows)
    feed = Feed(spark, tmp_path / "raw", schemas.MESSAGE)
    feed.add(batch)
    started = {}

    def start(messages, topic):
        started[topic] = messages.columns
        base = f"{tmp_path}/{topic}"
        return sinks.start_files(messages, base, f"{base}-checkpoint", drain=True)

    settings = Settings()
    queries = start_job(feed.stream(), start, settings)
    for query in queries:
        drain(query)
    assert started == {name: ["key", "value"] for name in ("processed_metrics", "alerts")}
    expected = results(batch, settings)
    limit = F.col("window_end") <= F.lit(at(198 - 60))
    for topic, result, rows_expected in zip(
        ("processed_metrics", "alerts"),
        (schemas.METRIC, schemas.ALERT),
        expected,
        strict=True,
    ):
        log = spark.read.parquet(f"{tmp_path}/{topic}").select(
            F.col("key").cast("binary").alias("key"),
            F.col("value").cast("binary").alias("value"),
            F.lit(0).cast("bigint").alias("offset"),
        )
        found = serving.result_stream(log, result).select(*result.fieldNames())
        assert sorted(rows_of(found)) == sorted(rows_of(rows_expected.filter(limit))) != []


def test_job_with_console_starts_five_queries(spark, tmp_path, monkeypatch):
    from tickflow.streaming import job

    named = []

    def checkpoint_path(spark, name):
        named.append(name)
        return f"{tmp_path}/{name}"

    monkeypatch.setattr(job, "checkpoint_path", checkpoint_path)
    feed = Feed(spark, tmp_path / "raw", schemas.MESSAGE)
    feed.add(raw_messages(spark, [("A", 1, 1.0, 1.0)]))

    def start(messages, topic):
        base = f"{tmp_path}/{topic}"
        return sinks.start_files(messages, base, f"{base}-checkpoint", drain=True)

    queries = start_job(feed.stream(), start, Settings(), console=True)
    try:
        assert len(queries) == 5
        assert named == ["console-messages", "console-metrics", "console-alerts"]
        for query in queries:
            query.processAllAvailable()
            assert query.exception() is None
    finally:
        for query in queries:
            query.stop()
        spark.streams.resetTerminated()


def test_ingest_publishes_accepted_trades(spark, messages, tmp_path):
    envelopes = messages(
        {"stream": "x", "data": {"E": 1, "s": "A", "p": "1", "q": "2", "m": True}},
        {"result": None},
    )
    feed = Feed(spark, tmp_path / "feed", envelopes.schema)
    feed.add(envelopes)

    def start(out, topic):
        assert topic == "raw_trades"
        return sinks.start_files(out, f"{tmp_path}/o", f"{tmp_path}/c", drain=True)

    drain(start_ingest(feed.stream(), start))
    published = spark.read.parquet(f"{tmp_path}/o")
    assert rows_of(published, "key", F.get_json_object("value", "$.m")) == [("A", "true")]


def test_parse_works_on_streams(spark, messages, tmp_path):
    batch = messages({"E": ms(1), "s": "A", "p": "1", "q": "2"}, "not json")
    feed = Feed(spark, tmp_path / "raw", batch.schema)
    feed.add(batch)
    bad, _ = to_files(pa.quarantine(feed.stream()), tmp_path)
    assert rows_of(bad, "reason") == [("malformed",)]
