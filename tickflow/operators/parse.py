"""From message bytes to typed rows: unwrap, validate, parse, decode, coerce."""

from __future__ import annotations

import secrets
from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tickflow import schemas
from tickflow.functions import event_instant, finite, number, strict_number, utf8

_MALFORMED = "malformed"
_MARK = f"end-{secrets.token_hex(16)}"


def open_json(
    rows: DataFrame,
    text: Column,
    layout: T.StructType,
    prefix: str,
    flag: bool = False,
    **options: str,
) -> DataFrame:
    """Add the fields of a JSON object as columns named ``prefix`` + field.

    With ``flag``, text that does not fit the layout comes as ``prefix`` + ``malformed``.
    The parse sits in a generator because filters stop above one: a filter on a plain
    ``from_json`` column is pushed below it and parses every message a second time.
    """
    if flag:
        layout = T.StructType([*layout.fields, T.StructField(_MALFORMED, T.StringType())])
        options["columnNameOfCorruptRecord"] = _MALFORMED
    names = [f"{prefix}{name}" for name in layout.fieldNames()]
    parsed = F.array(F.from_json(text, layout, options))
    return rows.select("*", F.inline(parsed).alias(*names))


def open_object(rows: DataFrame, text: Column, fields: Sequence[str], prefix: str) -> DataFrame:
    """Add the fields of a JSON object as text, and whether it is one as ``prefix`` + ``ok``.

    See ``open_entry``.
    """
    entry = T.StructType([T.StructField(name, T.StringType()) for name in fields])
    return open_entry(rows, text, entry, prefix)


def open_entry(rows: DataFrame, text: Column, layout: T.StructType, prefix: str) -> DataFrame:
    """Add the fields of a JSON object, typed by ``layout``, and whether it is one.

    Strict: the text must be one object and nothing else, while a parse of the text itself
    would ignore what follows the first object. So the text is put as the only entry of a
    list, a second list follows with a mark that no text can hold, as every process draws it
    anew, and both are parsed at once: it is one object if there are these two lists with an
    entry each and the mark is in its place.
    """
    enclosed = F.concat(F.lit("[["), text, F.lit(f'],[{{"{_MARK}":1}}]]'))
    marked = T.StructType([*layout.fields, T.StructField(_MARK, T.IntegerType())])
    parsed = F.from_json(enclosed, T.ArrayType(T.ArrayType(marked)), {"allowSingleQuotes": "false"})
    opened = rows.select("*", F.inline(F.array(F.struct(parsed.alias(f"{prefix}lists")))))
    lists = F.col(f"{prefix}lists")
    entries, ends = F.get(lists, F.lit(0)), F.get(lists, F.lit(1))
    only = F.get(entries, F.lit(0))
    one_object = (
        (F.size(lists) == 2) & (F.size(entries) == 1) & (F.size(ends) == 1)
        & only.isNotNull() & F.get(ends, F.lit(0))[_MARK].isNotNull()
    )
    ok = F.coalesce(one_object, F.lit(False))
    return opened.select(
        *rows.columns,
        *(F.when(ok, only[name]).alias(f"{prefix}{name}") for name in layout.fieldNames()),
        ok.alias(f"{prefix}ok"),
    )


def unwrap(messages: DataFrame) -> DataFrame:
    """Open feed envelopes: adds ``stream``, ``payload`` (JSON text) and ``trade`` (struct).

    The payload text keeps every field of the trade for republishing, whatever the schema of
    ``trade`` covers; it is only read where it is used. All three are empty where the message
    is no JSON object, and the last two where its ``data`` is none.
    """
    texts = messages.withColumn("envelope_text", utf8(F.col("value")))
    text = F.col("envelope_text")
    # Typed from the envelope, not from the payload text: that text looks the same whether
    # ``data`` is an object or a string that quotes one.
    layout = T.StructType([T.StructField("stream", T.StringType()), T.StructField("data", schemas.FEED_TRADE)])
    opened = open_entry(texts, text, layout, "envelope_")
    payload = F.from_json(text, "data STRING")["data"]
    return opened.select(
        *messages.columns,
        F.col("envelope_stream").alias("stream"),
        F.when(F.col("envelope_data").isNotNull(), payload).alias("payload"),
        F.col("envelope_data").alias("trade"),
    )


def _has_symbol() -> Column:
    return F.col("trade.s").isNotNull()


def accepted(unwrapped: DataFrame) -> DataFrame:
    """Unwrapped messages that hold a trade with a symbol."""
    return unwrapped.filter(_has_symbol())


def rejected(unwrapped: DataFrame) -> DataFrame:
    """The other unwrapped messages: empty or foreign envelopes, trades without a symbol."""
    return unwrapped.filter(~_has_symbol())


def trade_summary(unwrapped: DataFrame) -> DataFrame:
    """What a log line of a trade shows, missing fields replaced by their defaults."""
    fields = {"trade_id": "t", "symbol": "s", "price": "p", "quantity": "q"}
    return unwrapped.select(
        *(
            F.coalesce(F.col(f"trade.{fields[name]}"), F.lit(default)).alias(name)
            for name, default in schemas.TRADE_DEFAULTS.items()
        )
    )


def republish(unwrapped: DataFrame) -> DataFrame:
    """Accepted trades as keyed messages for the raw-trade topic."""
    return unwrapped.select(F.col("trade.s").alias("key"), F.col("payload").alias("value"))


def parse_trades(
    messages: DataFrame,
    strict: bool = False,
    carry: Sequence[str] = ("offset",),
    plausible: tuple[int, int] = schemas.EVENT_RANGE,
) -> DataFrame:
    """Trade messages to typed trades, plus the message columns named in ``carry``.

    Broken JSON gives NULL fields; a price or quantity that is no finite number gives NULL,
    and so does an event time outside the ``plausible`` milliseconds. ``strict`` fails the
    query on texts that are no numbers instead, and lets NaN and infinities through.
    ``offset`` is carried by default because it gives the arrival order that first and last
    prices need.
    """
    to_number = strict_number if strict else _trade_number
    text = F.col("value").cast("string")
    parsed = open_json(messages.select("value", *carry), text, schemas.RAW_TRADE, "raw_")
    return parsed.select(
        F.col("raw_s").alias("symbol"),
        event_instant(F.col("raw_E"), plausible).alias("event_time"),
        to_number(F.col("raw_p")).alias("price"),
        to_number(F.col("raw_q")).alias("quantity"),
        *carry,
    ).select(
        "symbol",
        "event_time",
        "price",
        "quantity",
        (F.col("price") * F.col("quantity")).alias("volume_price"),
        *carry,
    )


def _trade_number(text: Column) -> Column:
    return finite(number(text))


def quarantine(
    messages: DataFrame, plausible: tuple[int, int] = schemas.EVENT_RANGE
) -> DataFrame:
    """Messages that ``parse_trades`` could not type fully, with the ``reason``.

    A side output: ``parse_trades`` still passes these rows on with NULLs.
    """
    text = F.col("value").cast("string")
    inspected = open_json(messages, text, schemas.RAW_TRADE, "raw_", flag=True)
    no_symbol = F.col("raw_s").isNull()
    reason = (
        F.when(text.isNull(), "no text")
        .when(no_symbol & F.col(f"raw_{_MALFORMED}").isNotNull(), "malformed")
        .when(no_symbol, "no symbol")
        .when(event_instant(F.col("raw_E"), plausible).isNull(), "no event time")
        .when(_trade_number(F.col("raw_p")).isNull(), "price is no number")
        .when(_trade_number(F.col("raw_q")).isNull(), "quantity is no number")
    )
    return inspected.select(*messages.columns, reason.alias("reason")).filter(
        F.col("reason").isNotNull()
    )


def decode_payload(
    messages: DataFrame, fields: Sequence[str], carry: Sequence[str] = ()
) -> DataFrame:
    """Result messages to rows: one text column per field, and the message key as ``key``.

    Absent fields are NULL. Messages without a value, with bytes that are not UTF-8 or with
    anything but a JSON object are dropped one by one.
    """
    texts = messages.select(
        utf8(F.col("value")).alias("text"),
        F.col("key").isNull().alias("keyless"),
        utf8(F.col("key")).alias("key"),
        *carry,
    )
    decoded = open_object(texts, F.col("text"), fields, "payload_")
    readable = F.col("payload_ok") & (F.col("keyless") | F.col("key").isNotNull())
    return decoded.filter(readable).select(
        *(F.col(f"payload_{name}").alias(name) for name in fields),
        F.nullif("key", F.lit("")).alias("key"),
        *carry,
    )


# A trailing d or f is a Java number suffix, not part of a number.
_JAVA_SUFFIX = r"[0-9.][dDfF]\s*$"


def coerce(rows: DataFrame, times: Iterable[str] = (), numbers: Iterable[str] = ()) -> DataFrame:
    """Turn text columns into timestamps and doubles; text that is neither becomes NULL.

    So does NaN, which stands for a missing number here. Columns that the input does not
    have are skipped.
    """
    present = set(rows.columns)
    typed = {name: F.try_to_timestamp(F.col(name)) for name in times if name in present}
    for name in numbers:
        if name in present:
            text = F.col(name).cast("string")
            value = number(text)
            typed[name] = F.when(~text.rlike(_JAVA_SUFFIX) & ~F.isnan(value), value)
    return rows.withColumns(typed) if typed else rows


def coerce_metrics(rows: DataFrame) -> DataFrame:
    return coerce(rows, times=["window_end"], numbers=["vwap", "total_volume"])


def coerce_alerts(rows: DataFrame) -> DataFrame:
    return coerce(
        rows,
        times=["window_start", "window_end"],
        numbers=["percent_change", "first_price", "last_price"],
    )


def drop_missing_window(rows: DataFrame) -> DataFrame:
    return rows.na.drop(subset=["window_end"])


def only_symbols(trades: DataFrame, symbols: Sequence[str] = schemas.SYMBOLS) -> DataFrame:
    """Trades of the chosen symbols.

    Over a typed table the predicate reaches the scan; over parsed messages it is applied
    after the parse.
    """
    return trades.filter(F.col("symbol").isin(*symbols))
