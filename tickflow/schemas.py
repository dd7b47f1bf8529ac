"""Data contracts and the fixed values that downstream consumers rely on."""

from __future__ import annotations

from pyspark.sql import types as T

# Topics, symbols, window sizes, thresholds and stand-ins for missing values
# that users of an existing deployment expect. All but the stand-ins are only defaults.
RAW_TOPIC = "raw_trades"
METRICS_TOPIC = "processed_metrics"
ALERTS_TOPIC = "alerts"
SYMBOLS = ("BTCUSDT", "ETHUSDT", "BNBUSDT", "SOLUSDT", "XRPUSDT")
VWAP_LENGTH = "30 seconds"
VWAP_SLIDE = "10 seconds"
ALERT_LENGTH = "10 seconds"
ALERT_THRESHOLD = 1.0
WATERMARK_DELAY = "1 minute"
REFRESH_INTERVAL = "5 seconds"
SERVERS_VARIABLE = "KAFKA_BOOTSTRAP_SERVERS"
ALERT_LENGTH_VARIABLE = "VOLATILITY_WINDOW"
ALERT_THRESHOLD_VARIABLE = "VOLATILITY_THRESHOLD"
METRICS_GROUP_VARIABLE = "KAFKA_DASHBOARD_GROUP_ID"
ALERTS_GROUP_VARIABLE = "KAFKA_ALERTS_GROUP_ID"
DEFAULT_SERVERS = "kafka:9092"
# Event times in Unix milliseconds that are taken for real: the years 1970 to 2099.
EVENT_RANGE = (0, 4_102_444_799_999)
TRADE_DEFAULTS = {"trade_id": "N/A", "symbol": "N/A", "price": "-1", "quantity": "-1"}
MISSING_SYMBOL_IN_KEY = "None"
MISSING_TIME_IN_KEY = "NaT"
MISSING_SYMBOL = "UNKNOWN"
MISSING_VALUE = "N/A"

# Rows as the Kafka source delivers them; file sources use the same shape.
MESSAGE = T.StructType(
    [
        T.StructField("key", T.BinaryType()),
        T.StructField("value", T.BinaryType()),
        T.StructField("topic", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
        T.StructField("timestamp", T.TimestampType()),
        T.StructField("timestampType", T.IntegerType()),
    ]
)

# Trade JSON: event time in Unix milliseconds, symbol, price and quantity as text.
RAW_TRADE = T.StructType(
    [
        T.StructField("E", T.LongType()),
        T.StructField("s", T.StringType()),
        T.StructField("p", T.StringType()),
        T.StructField("q", T.StringType()),
    ]
)
# The feed also carries a trade id, which only the log line of a trade shows.
FEED_TRADE = T.StructType([*RAW_TRADE.fields, T.StructField("t", T.StringType())])

METRIC = T.StructType(
    [
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("vwap", T.DoubleType()),
        T.StructField("total_volume", T.DoubleType()),
    ]
)
ALERT = T.StructType(
    [
        T.StructField("window_start", T.TimestampType()),
        T.StructField("window_end", T.TimestampType()),
        T.StructField("symbol", T.StringType()),
        T.StructField("first_price", T.DoubleType()),
        T.StructField("last_price", T.DoubleType()),
        T.StructField("percent_change", T.DoubleType()),
    ]
)
METRIC_COLUMNS = tuple(METRIC.fieldNames())
RESULT_KEY = ("symbol", "window_end")
