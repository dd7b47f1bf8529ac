"""Column expressions. All of them stay inside the JVM."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from tickflow import schemas

# Microseconds either side of the epoch that fit 18 digits: some 31,000 years.
_WIDEST_MICROS = 10**18 - 1


def utf8(binary: Column) -> Column:
    """Bytes to text; NULL when the bytes are not valid UTF-8."""
    return F.try_validate_utf8(binary.cast("string"))


def event_instant(millis: Column, plausible: tuple[int, int] = schemas.EVENT_RANGE) -> Column:
    """Unix milliseconds to TIMESTAMP; NULL outside the ``plausible`` range.

    A time in another unit, microseconds say, is far outside. Let through, one such time would
    move a stream's watermark past every later trade.
    """
    return F.when(millis.between(*plausible), F.timestamp_millis(millis))


def number(text: Column) -> Column:
    """Text to DOUBLE; text that is no number becomes NULL."""
    return text.try_cast("double")


def finite(value: Column) -> Column:
    """A DOUBLE as it is; NaN and the infinities become NULL."""
    return F.when(F.abs(value) < float("inf"), value)


def strict_number(text: Column) -> Column:
    """Text to DOUBLE; under ANSI mode text that is no number fails the query."""
    return text.cast("double")


def ratio(numerator: Column, denominator: Column) -> Column:
    """Quotient, NULL when the denominator is zero."""
    return F.try_divide(numerator, denominator)


def percent_change(first: Column, last: Column) -> Column:
    """Change from ``first`` to ``last`` in percent, zero when ``first`` is zero."""
    return F.when(first == 0, F.lit(0.0)).otherwise((last - first) / first * 100.0)


def order_key(event_time: Column, arrival: Column) -> Column:
    """(event_time, arrival) as one sortable DECIMAL.

    ``min_by``/``max_by`` over a struct cannot use hash aggregation and would sort every
    input row first; a decimal keeps the map-side combine a hash aggregation. Microseconds
    are 10^20 apart, which leaves room for any 64-bit arrival number, negative ones included.
    Times some 31,000 years from the epoch or farther count as equal.
    """
    held = F.greatest(F.unix_micros(event_time), F.lit(-_WIDEST_MICROS))
    micros = F.least(held, F.lit(_WIDEST_MICROS)).cast("decimal(18,0)")
    apart = F.lit(str(10**20)).cast("decimal(21,0)")
    return F.when(event_time.isNotNull(), micros * apart + arrival_number(arrival).cast("decimal(20,0)"))


def arrival_number(arrival: Column) -> Column:
    """A 64-bit arrival number; one that is missing is before all others."""
    return F.coalesce(arrival, F.lit(-(2**63)))


def _moment_text(moment: Column, separator: str) -> Column:
    base = f"yyyy-MM-dd{separator}HH:mm:ss"
    whole = F.date_format(moment, f"{base}xxx")
    fractional = F.date_format(moment, f"{base}.SSSSSSxxx")
    return F.when(F.unix_micros(moment) % 1_000_000 == 0, whole).otherwise(fractional)


def alert_key(symbol: Column, window_end: Column) -> Column:
    """Text identity of an alert: symbol, underscore, ISO window end."""
    return F.concat_ws(
        "_",
        F.coalesce(symbol, F.lit(schemas.MISSING_SYMBOL_IN_KEY)),
        F.coalesce(_moment_text(window_end, "'T'"), F.lit(schemas.MISSING_TIME_IN_KEY)),
    )


def number_text(value: Column) -> Column:
    """DOUBLE in plain digits (``12345678.9``, not ``1.23456789E7``) up to 1e16."""
    text = value.cast("string")
    size = F.abs(value)
    digits = F.regexp_replace(value.try_cast("decimal(38,21)").cast("string"), "0+$", "")
    plain = F.regexp_replace(digits, r"\.$", ".0")
    return F.when(text.contains("E") & (size >= 1e-4) & (size < 1e16), plain).otherwise(text)


def alert_line(
    symbol: Column, change: Column, first: Column, last: Column, window_end: Column
) -> Column:
    """One alert as a line of text.

    ``format_number`` rounds the exact binary value half-even, which is what two-decimal
    formatting does elsewhere; ``format_string('%.2f')`` rounds the shortest decimal half-up.
    """
    missing = F.lit(schemas.MISSING_VALUE)
    two_places = F.call_function(
        "format_number", F.coalesce(change, F.lit(0.0)), F.lit("0.00")
    )
    return F.concat(
        F.coalesce(symbol, F.lit(schemas.MISSING_SYMBOL)),
        F.lit(": "),
        two_places,
        F.lit("% change ("),
        F.coalesce(number_text(first), missing),
        F.lit(" -> "),
        F.coalesce(number_text(last), missing),
        F.lit(") at "),
        F.coalesce(_moment_text(window_end, " "), missing),
    )
