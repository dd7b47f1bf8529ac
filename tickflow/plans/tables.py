"""The given tables as trades and messages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# The columns that queries use, so that reading a table needs no look into its files first.
EVENTS = T.StructType(
    [
        T.StructField("event_id", T.LongType()),
        T.StructField("ts", T.TimestampNTZType()),
        T.StructField("event_type", T.StringType()),
        T.StructField("value", T.DoubleType()),
        T.StructField("props", T.StringType()),
    ]
)
LINEITEM = T.StructType(
    [
        T.StructField("l_returnflag", T.StringType()),
        T.StructField("l_linestatus", T.StringType()),
        T.StructField("l_shipdate", T.TimestampNTZType()),
        T.StructField("l_extendedprice", T.DoubleType()),
        T.StructField("l_quantity", T.DoubleType()),
    ]
)
ORDERS = T.StructType(
    [
        T.StructField("o_orderkey", T.LongType()),
        T.StructField("o_orderpriority", T.StringType()),
        T.StructField("o_orderdate", T.TimestampNTZType()),
        T.StructField("o_totalprice", T.DoubleType()),
    ]
)
DOCUMENTS = T.StructType(
    [T.StructField("doc_id", T.LongType()), T.StructField("text", T.StringType())]
)
_TABLES = {
    "events": EVENTS,
    "lineitem": LINEITEM,
    "orders": ORDERS,
    "documents": DOCUMENTS,
}


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_TABLES[name]).parquet(f"{sf_dir}/{name}.parquet")


def stream_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events table as a stream of files.

    The pattern in the path lets it be a single file as well as a folder of files.
    """
    return spark.readStream.schema(EVENTS).parquet(f"{sf_dir}/{{events}}.parquet")


def _quantity():
    return F.from_json("props", "k DOUBLE").getField("k")


def event_trades(events: DataFrame) -> DataFrame:
    """Events as typed trades: type as symbol, value as price, ``k`` as quantity."""
    return events.select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("event_time"),
        F.col("value").alias("price"),
        _quantity().alias("quantity"),
        F.col("event_id").alias("offset"),
    ).withColumn("volume_price", F.col("price") * F.col("quantity"))


def lineitem_trades(lineitem: DataFrame) -> DataFrame:
    """Line items as trades: return flag and line status as symbol, ship date as time."""
    return lineitem.select(
        F.concat("l_returnflag", "l_linestatus").alias("symbol"),
        F.col("l_shipdate").cast("timestamp").alias("event_time"),
        F.col("l_extendedprice").alias("price"),
        F.col("l_quantity").alias("quantity"),
        (F.col("l_extendedprice") * F.col("l_quantity")).alias("volume_price"),
    )


def order_trades(orders: DataFrame) -> DataFrame:
    """Orders as trades of one unit: priority as symbol, total as price, key as arrival."""
    return orders.select(
        F.col("o_orderpriority").alias("symbol"),
        F.col("o_orderdate").cast("timestamp").alias("event_time"),
        F.col("o_totalprice").alias("price"),
        F.lit(1.0).alias("quantity"),
        F.col("o_totalprice").alias("volume_price"),
        F.col("o_orderkey").alias("offset"),
    )


def _trade_fields(events: DataFrame) -> DataFrame:
    return events.select(
        "event_id",
        "ts",
        F.col("event_type").alias("s"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("E"),
        F.col("value").cast("string").alias("p"),
        F.get_json_object("props", "$.k").alias("q"),
    )


def _as_messages(rows: DataFrame, value, topic: str) -> DataFrame:
    return rows.select(
        F.col("s").cast("binary").alias("key"),
        value.cast("binary").alias("value"),
        F.lit(topic).alias("topic"),
        F.lit(0).alias("partition"),
        F.col("event_id").alias("offset"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.lit(0).alias("timestampType"),
    )


def event_messages(events: DataFrame) -> DataFrame:
    """Events as raw-trade messages in the shape of the Kafka source."""
    rows = _trade_fields(events)
    return _as_messages(rows, F.to_json(F.struct("E", "s", "p", "q")), "raw_trades")


def event_envelopes(events: DataFrame) -> DataFrame:
    """Events as feed envelopes; error events come without a symbol, as a feed's notices do."""
    rows = _trade_fields(events)
    trade = F.struct(
        "E",
        F.when(F.col("s") != "error", F.col("s")).alias("s"),
        F.col("event_id").alias("t"),
        "p",
        "q",
    )
    envelope = F.struct(
        F.concat("s", F.lit("@trade")).alias("stream"),
        trade.alias("data"),
    )
    return _as_messages(rows, F.to_json(envelope), "feed")


def text_messages(rows: DataFrame, number: str, text: str) -> DataFrame:
    """Whole texts as keyless messages."""
    return rows.select(
        F.lit(None).cast("binary").alias("key"),
        F.col(text).cast("binary").alias("value"),
        F.col(number).cast("bigint").alias("offset"),
    )


def result_messages(messages: DataFrame, arrival) -> DataFrame:
    """(key, value) messages with the columns a reader of the topic sees."""
    return messages.select(
        F.col("key").cast("binary").alias("key"),
        F.col("value").cast("binary").alias("value"),
        arrival.alias("offset"),
    )
