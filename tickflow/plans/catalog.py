"""Named queries over the given tables: one or more per operator."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow import schemas
from tickflow.functions import alert_key
from tickflow.operators import alerts as al
from tickflow.operators import metrics as me
from tickflow.operators import parse as pa
from tickflow.operators import views as vi
from tickflow.operators.messages import to_messages
from tickflow.plans import streams, tables

Query = Callable[[SparkSession, str], DataFrame]


def plain_times(rows: DataFrame) -> DataFrame:
    """Timestamps without zone, as SQL engines without instants return them."""
    instants = [f.name for f in rows.schema if f.dataType == T.TimestampType()]
    return rows.withColumns({c: F.col(c).cast("timestamp_ntz") for c in instants})


def _events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.read_table(spark, sf_dir, "events")


def _trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.event_trades(_events(spark, sf_dir))


def _metrics(spark: SparkSession, sf_dir: str, length: str, slide: str) -> DataFrame:
    return me.vwap(_trades(spark, sf_dir), length, slide, exact=True)


def _alerts(spark: SparkSession, sf_dir: str, length: str = "1 hour") -> DataFrame:
    return al.volatility(_trades(spark, sf_dir), length, 1.0, order="event_time")


# --- windowed metrics -------------------------------------------------------------------


def vwap_sliding_default(spark, sf_dir):
    return _metrics(spark, sf_dir, schemas.VWAP_LENGTH, schemas.VWAP_SLIDE)


def vwap_sliding_30m(spark, sf_dir):
    return _metrics(spark, sf_dir, "30 minutes", "10 minutes")


def vwap_uneven_windows(spark, sf_dir):
    """Window length that is no multiple of the slide."""
    return _metrics(spark, sf_dir, "25 minutes", "10 minutes")


def vwap_valid_trades(spark, sf_dir):
    """Trades with a price of zero count as priceless and are left out."""
    trades = _trades(spark, sf_dir).withColumn("price", F.nullif("price", F.lit(0.0)))
    return me.vwap(trades, "1 hour", "1 hour", exact=True, valid_only=True)


def vwap_from_json(spark, sf_dir):
    """Messages in, metrics out: parse, window, aggregate."""
    trades = pa.parse_trades(tables.event_messages(_events(spark, sf_dir)))
    return me.vwap(trades, exact=True)


def vwap_lineitem(spark, sf_dir):
    trades = tables.lineitem_trades(tables.read_table(spark, sf_dir, "lineitem"))
    return me.vwap(trades, "30 days", "10 days", exact=True)


def _in_cents(trades: DataFrame) -> DataFrame:
    """Prices as whole cents: double sums of whole numbers are the same in any order."""
    cents = trades.withColumn("price", F.round(F.col("price") * 100))
    return cents.withColumn("volume_price", F.col("price") * F.col("quantity"))


def vwap_cents(spark, sf_dir):
    """Default windows and default arithmetic."""
    return me.vwap(_in_cents(_trades(spark, sf_dir)))


def vwap_lineitem_cents(spark, sf_dir):
    trades = tables.lineitem_trades(tables.read_table(spark, sf_dir, "lineitem"))
    return me.vwap(_in_cents(trades), "30 days", "10 days")


def symbol_subset_vwap(spark, sf_dir):
    trades = pa.only_symbols(_trades(spark, sf_dir), ["click", "purchase"])
    return me.vwap(trades, "30 minutes", "10 minutes", exact=True)


def volume_tumbling(spark, sf_dir):
    return me.volume(_trades(spark, sf_dir), exact=True)


# --- prices and alerts ------------------------------------------------------------------


def first_last_price(spark, sf_dir):
    return al.first_last(_trades(spark, sf_dir), "10 minutes", order="event_time")


def first_last_arrival(spark, sf_dir):
    return al.first_last(_trades(spark, sf_dir), "1 hour")


def volatility_alerts_default(spark, sf_dir):
    return al.volatility(_trades(spark, sf_dir), order="event_time")


def volatility_alerts_1h(spark, sf_dir):
    return _alerts(spark, sf_dir)


def volatility_alerts_arrival(spark, sf_dir):
    return al.volatility(_trades(spark, sf_dir), "30 minutes", 5.0)


def order_alerts(spark, sf_dir):
    """Orders as trades; arrival is the order key, which does not follow the date."""
    trades = tables.order_trades(tables.read_table(spark, sf_dir, "orders"))
    return al.volatility(trades, "1 day", 10.0, order="event_time")


def _panes(spark, sf_dir):
    return me.trade_panes(_trades(spark, sf_dir), "10 minutes", exact=True, order="arrival")


def panes_to_vwap(spark, sf_dir):
    return me.vwap_from_panes(_panes(spark, sf_dir), "30 minutes", "10 minutes")


def panes_to_alerts(spark, sf_dir):
    return al.alerts_over(al.first_last_from_panes(_panes(spark, sf_dir), "1 hour"))


# --- parsing ----------------------------------------------------------------------------


def parse_trades_json(spark, sf_dir):
    return pa.parse_trades(tables.event_messages(_events(spark, sf_dir)))


def _unwrapped(spark, sf_dir):
    return pa.unwrap(tables.event_envelopes(_events(spark, sf_dir)))


def unwrap_envelope(spark, sf_dir):
    fields = [F.col(f"trade.{c}").alias(n) for c, n in zip("stpq", _TRADE_NAMES, strict=True)]
    event_ms = F.col("trade.E").alias("event_ms")
    return _unwrapped(spark, sf_dir).select("stream", event_ms, *fields)


_TRADE_NAMES = ("symbol", "trade_id", "price", "quantity")


def validate_trades(spark, sf_dir):
    return pa.accepted(_unwrapped(spark, sf_dir)).select("offset", "trade.s")


def rejected_trades(spark, sf_dir):
    return pa.rejected(_unwrapped(spark, sf_dir)).select("offset", "stream")


def default_fill(spark, sf_dir):
    return pa.trade_summary(_unwrapped(spark, sf_dir))


def default_fill_each(spark, sf_dir):
    """Envelopes of which each lacks another field of the trade, or the trade."""
    events, case = _events(spark, sf_dir), F.col("offset") % 6
    value = F.col("value").cast("string")
    trade = F.from_json(value, T.StructType([T.StructField("data", schemas.FEED_TRADE)]))["data"]
    some = F.struct(
        *(F.when(case != n, trade[name]).alias(name) for n, name in enumerate(("t", "s", "p", "q")))
    )
    lacking = F.to_json(F.struct(F.when(case != 4, some).alias("data")))
    messages = tables.event_envelopes(events).withColumn("value", lacking.cast("binary"))
    return pa.trade_summary(pa.unwrap(messages))


def quarantine_messages(spark, sf_dir):
    """Trades that parse, envelopes and documents that do not."""
    events = _events(spark, sf_dir)
    documents = tables.read_table(spark, sf_dir, "documents")
    texts = tables.text_messages(documents, "doc_id", "text")
    mixed = vi.append_batches(
        tables.event_messages(events).withColumn("topic", F.lit("trades")),
        tables.event_envelopes(events).withColumn("topic", F.lit("envelopes")),
        texts.withColumn("topic", F.lit("documents")),
    )
    return pa.quarantine(mixed).select("topic", "offset", "reason")


# --- messages ---------------------------------------------------------------------------


def _read_back(messages: DataFrame, layout: str) -> DataFrame:
    return messages.select("key", F.from_json("value", layout).alias("v")).select("key", "v.*")


def metric_messages(spark, sf_dir):
    messages = to_messages(_metrics(spark, sf_dir, "30 minutes", "10 minutes"))
    layout = "window_end TIMESTAMP, symbol STRING, vwap DOUBLE, total_volume DOUBLE"
    return _read_back(messages, layout)


def alert_messages(spark, sf_dir):
    layout = (
        "window_start TIMESTAMP, window_end TIMESTAMP, symbol STRING, first_price DOUBLE, "
        "last_price DOUBLE, percent_change DOUBLE"
    )
    return _read_back(to_messages(_alerts(spark, sf_dir)), layout)


def raw_trade_messages(spark, sf_dir):
    """Republished trades keep fields that no schema names."""
    messages = pa.republish(pa.accepted(_unwrapped(spark, sf_dir)))
    back = _read_back(messages, "E BIGINT, t BIGINT, s STRING, p STRING, q STRING")
    names = {"E": "event_ms", "t": "trade_id", "s": "symbol", "p": "price", "q": "quantity"}
    return back.withColumnsRenamed(names)


def _result_log(spark, sf_dir) -> DataFrame:
    """Hourly metrics as a topic would hold them, between texts that are no results."""
    metrics = to_messages(_metrics(spark, sf_dir, "1 hour", "1 hour"))
    documents = tables.read_table(spark, sf_dir, "documents")
    return vi.append_batches(
        tables.result_messages(metrics, F.lit(0).cast("bigint")),
        tables.text_messages(documents, "doc_id", "text").select("key", "value", "offset"),
    )


def decode_payload(spark, sf_dir):
    decoded = pa.decode_payload(_result_log(spark, sf_dir), schemas.METRIC_COLUMNS)
    return pa.coerce_metrics(decoded)


def coerce_types(spark, sf_dir):
    """Texts of which some are no time or no number; rows without a window are dropped."""
    kind = F.col("event_type")
    texts = _events(spark, sf_dir).select(
        "event_id",
        F.when(kind == "view", "soon").otherwise(F.col("ts").cast("string")).alias("window_end"),
        F.when(kind == "click", F.col("props"))
        .otherwise(F.col("value").cast("string"))
        .alias("vwap"),
        F.when(kind == "error", kind)
        .otherwise(F.get_json_object("props", "$.k"))
        .alias("total_volume"),
    )
    return pa.drop_missing_window(pa.coerce_metrics(texts))


# --- views ------------------------------------------------------------------------------


def append_batches(spark, sf_dir):
    trades = _trades(spark, sf_dir)
    return vi.append_batches(
        me.vwap(trades, "1 hour", "1 hour", exact=True),
        me.volume(trades, "30 minutes", exact=True),
    )


def _tick_log(spark, sf_dir) -> DataFrame:
    """A metric message per trade, so every hour and symbol arrives many times over."""
    return _trades(spark, sf_dir).select(
        F.window("event_time", "1 hour").end.alias("window_end"),
        "symbol",
        F.col("price").alias("vwap"),
        F.col("quantity").alias("total_volume"),
        F.col("offset").alias("arrival"),
    )


def dedupe_keep_last(spark, sf_dir):
    return vi.keep_last(_tick_log(spark, sf_dir), "arrival")


def upsert_metrics(spark, sf_dir):
    """Decoded messages, upserted on the raw text of the window end."""
    ticks = _tick_log(spark, sf_dir)
    log = tables.result_messages(
        to_messages(ticks), F.get_json_object("value", "$.arrival").cast("bigint")
    )
    decoded = pa.decode_payload(log, schemas.METRIC_COLUMNS, carry=["offset"]).drop("key")
    typed = pa.coerce(decoded, numbers=["vwap", "total_volume"])
    return pa.coerce(vi.upsert(typed, "offset"), times=["window_end"])


def latest_per_symbol(spark, sf_dir):
    return vi.latest_rows(_metrics(spark, sf_dir, "30 minutes", "10 minutes"))


def latest_nonnull_per_symbol(spark, sf_dir):
    """VWAP is missing where the volume is zero, so columns may come from different rows."""
    return vi.latest_values(_metrics(spark, sf_dir, schemas.VWAP_LENGTH, schemas.VWAP_SLIDE))


def record_counts(spark, sf_dir):
    return vi.record_count(_metrics(spark, sf_dir, schemas.VWAP_LENGTH, schemas.VWAP_SLIDE))


def vwap_pivot(spark, sf_dir):
    return vi.wide_series(_metrics(spark, sf_dir, "30 minutes", "10 minutes"), "vwap", _KINDS)


def volume_pivot(spark, sf_dir):
    metrics = _metrics(spark, sf_dir, "30 minutes", "10 minutes")
    return vi.wide_series(metrics, "total_volume", _KINDS)


_KINDS = ("click", "error", "purchase", "signup", "view")


def wide_many_symbols(spark, sf_dir):
    """Hourly volumes of sixty symbols, five of them not listed, in 56 columns."""
    trades = _trades(spark, sf_dir)
    kinds = trades.withColumn(
        "symbol", F.concat("symbol", F.lit("_"), (F.col("offset") % 12).cast("string"))
    )
    metrics = me.vwap(kinds, "1 hour", "1 hour", exact=True)
    return vi.wide_series(metrics, "total_volume", MANY_SYMBOLS)


MANY_SYMBOLS = [f"{kind}_{n}" for kind in _KINDS for n in range(11)] + ["absent"]


def _bad_trades(spark, sf_dir) -> DataFrame:
    """Trade messages some of which have an event time in microseconds or none, or a price or
    quantity that is no finite number."""
    messages = tables.event_messages(_events(spark, sf_dir))
    text, case = F.col("value").cast("string"), F.col("offset") % 9
    trade = F.from_json(text, schemas.RAW_TRADE)
    broken = F.struct(
        F.when(case == 1, trade["E"] * 1000).when(case != 2, trade["E"]).alias("E"),
        trade["s"].alias("s"),
        F.when(case == 3, "NaN").when(case == 4, "-Infinity").otherwise(trade["p"]).alias("p"),
        F.when(case == 5, "NaN").when(case != 6, trade["q"]).alias("q"),
    )
    return messages.withColumn("value", F.to_json(broken).cast("binary"))


def alerts_with_bad_trades(spark, sf_dir):
    trades = pa.parse_trades(_bad_trades(spark, sf_dir))
    return al.volatility(trades, "1 hour", order="event_time")


def vwap_with_bad_trades(spark, sf_dir):
    return me.vwap(pa.parse_trades(_bad_trades(spark, sf_dir)), "1 hour", "1 hour", exact=True)


def quarantine_bad_trades(spark, sf_dir):
    return pa.quarantine(_bad_trades(spark, sf_dir)).select("offset", "reason")


def decode_tails(spark, sf_dir):
    """Objects that hold a document's text, most followed by tails that make them no object."""
    documents = tables.read_table(spark, sf_dir, "documents")
    text = F.to_json(F.struct(F.col("text").alias("symbol")))
    tails = F.array(*(F.lit(tail) for tail in DECODE_TAILS))
    tailed = documents.withColumn(
        "tailed", F.concat(text, F.get(tails, (F.col("doc_id") % len(DECODE_TAILS)).cast("int")))
    )
    messages = tables.text_messages(tailed, "doc_id", "tailed")
    decoded = pa.decode_payload(messages, ["symbol"], carry=["offset"])
    return decoded.select("offset", F.md5("symbol").alias("symbol_md5"))


DECODE_TAILS = ("", " ", "x", "}", "]}garbage", '],"list":[{"symbol":"B"}', '],"x":[]}', ",{}")


def metric_series(spark, sf_dir):
    return vi.series(_metrics(spark, sf_dir, "1 hour", "1 hour"))


def metric_listing(spark, sf_dir):
    return vi.metric_listing(_metrics(spark, sf_dir, "1 hour", "10 minutes"))


def recent_alerts(spark, sf_dir):
    return vi.recent_alerts(_alerts(spark, sf_dir))


def alert_listing(spark, sf_dir):
    return vi.alert_listing(_alerts(spark, sf_dir, "30 minutes"))


def alert_keys(spark, sf_dir):
    alerts = _alerts(spark, sf_dir)
    return alerts.select(alert_key(F.col("symbol"), F.col("window_end")).alias("alert_key"))


def alert_lines(spark, sf_dir):
    return vi.alert_lines(_alerts(spark, sf_dir))


def new_alerts(spark, sf_dir):
    """Alerts above 1 % that a display showing only those above 20 % has not shown."""
    alerts = _alerts(spark, sf_dir)
    seen = al.volatility(_trades(spark, sf_dir), "1 hour", 20.0, order="event_time")
    return vi.new_alerts(alerts, seen)


def _delivered(spark, sf_dir) -> DataFrame:
    """Alerts with the day that delivered them, and all of them again a day later."""
    alerts = _alerts(spark, sf_dir)
    day = F.to_date("window_end")
    return vi.append_batches(
        alerts.withColumn("refresh", day),
        alerts.withColumn("refresh", F.date_add(day, 1)),
    )


def first_shown_alerts(spark, sf_dir):
    return vi.first_shown(_delivered(spark, sf_dir), "refresh")


def new_alert_count(spark, sf_dir):
    return vi.new_alert_counts(_delivered(spark, sf_dir), "refresh")


BATCH: dict[str, Query] = {
    query.__name__: query
    for query in (
        vwap_sliding_default,
        vwap_sliding_30m,
        vwap_uneven_windows,
        vwap_valid_trades,
        vwap_from_json,
        vwap_lineitem,
        vwap_cents,
        vwap_lineitem_cents,
        symbol_subset_vwap,
        volume_tumbling,
        first_last_price,
        first_last_arrival,
        volatility_alerts_default,
        volatility_alerts_1h,
        volatility_alerts_arrival,
        order_alerts,
        panes_to_vwap,
        panes_to_alerts,
        parse_trades_json,
        unwrap_envelope,
        validate_trades,
        rejected_trades,
        default_fill,
        default_fill_each,
        quarantine_messages,
        metric_messages,
        alert_messages,
        raw_trade_messages,
        decode_payload,
        coerce_types,
        append_batches,
        dedupe_keep_last,
        upsert_metrics,
        latest_per_symbol,
        latest_nonnull_per_symbol,
        record_counts,
        vwap_pivot,
        volume_pivot,
        wide_many_symbols,
        alerts_with_bad_trades,
        vwap_with_bad_trades,
        quarantine_bad_trades,
        decode_tails,
        metric_series,
        metric_listing,
        recent_alerts,
        alert_listing,
        alert_keys,
        alert_lines,
        new_alerts,
        first_shown_alerts,
        new_alert_count,
    )
}


def _in_utc(query: Query) -> Query:
    """Run a query with UTC as session zone, which its windows and texts assume."""

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return plain_times(query(spark, str(sf_dir).rstrip("/")))

    run.__name__, run.__doc__ = query.__name__, query.__doc__
    return run


def all_queries() -> dict[str, Query]:
    return {name: _in_utc(query) for name, query in {**BATCH, **streams.STREAMS}.items()}
