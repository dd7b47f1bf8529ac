"""Windowed volume and volume-weighted average price."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tickflow import schemas
from tickflow.functions import arrival_number, finite, order_key, ratio
from tickflow.functions.durations import check_window, common_pane

EXACT_PLACES = 8


def _fitting(name: str, places: int) -> Column:
    """A double column as a decimal of 18 digits; a value that does not fit fails the query."""
    value = finite(F.col(name))
    decimal = value.try_cast(f"decimal(18,{places})")
    refused = F.raise_error(F.concat(F.lit(f"{name} does not fit {places} places: "), value.cast("string")))
    return F.when(value.isNull() | (decimal.cast("double") == value), decimal).otherwise(refused)


def _amounts(exact: bool | int) -> tuple[Column, Column]:
    """(price times quantity, quantity) in the number type that will be summed."""
    if exact is False:
        return finite(F.col("volume_price")), finite(F.col("quantity"))
    places = EXACT_PLACES if exact is True else exact
    quantity = _fitting("quantity", places)
    return _fitting("price", places) * quantity, quantity


def _sums(exact: bool | int) -> list[Column]:
    notional, volume = _amounts(exact)
    return [F.sum(notional).alias("notional"), F.sum(volume).alias("volume")]


def _finish(summed: DataFrame) -> DataFrame:
    notional, volume = F.col("notional").cast("double"), F.col("volume").cast("double")
    return summed.select(
        F.col("window.end").alias("window_end"),
        "symbol",
        ratio(notional, volume).alias("vwap"),
        volume.alias("total_volume"),
    )


def arrival_key(order: str, arrival: str) -> Column:
    """Sort key of first and last prices: ``arrival`` order, or ``event_time`` with arrival
    deciding between equal times."""
    if order == "arrival":
        return arrival_number(F.col(arrival))
    if order == "event_time":
        return order_key(F.col("event_time"), F.col(arrival))
    raise ValueError(f"order must be 'arrival' or 'event_time', not {order!r}")


def trade_panes(
    trades: DataFrame,
    pane: str,
    exact: bool | int = False,
    order: str | None = None,
    arrival: str = "offset",
) -> DataFrame:
    """One row per (pane, symbol): sums, and with ``order`` the first and last prices.

    The only pass over the trades that batch results need. The map-side combine collapses a
    task's trades before the shuffle, so a hot symbol costs one row per pane and task, and
    the result is small enough to write once and derive several reports from.
    """
    aggregates = _sums(exact)
    if order is not None:
        key = arrival_key(order, arrival)
        aggregates += [
            F.min_by("price", key).alias("first_price"),
            F.min(key).alias("first_at"),
            F.max_by("price", key).alias("last_price"),
            F.max(key).alias("last_at"),
        ]
    grouped = trades.groupBy(F.window("event_time", pane).alias("pane"), "symbol")
    return grouped.agg(*aggregates).select(
        F.col("pane.start").alias("pane_start"),
        "symbol",
        "notional",
        "volume",
        *(["first_price", "first_at", "last_price", "last_at"] if order else []),
    )


def vwap_from_panes(panes: DataFrame, length: str, slide: str) -> DataFrame:
    """Put sliding windows together from panes whose width divides ``length`` and ``slide``."""
    check_window(length, slide)
    window = F.window("pane_start", length, slide).alias("window")
    summed = panes.groupBy(window, "symbol").agg(
        F.sum("notional").alias("notional"), F.sum("volume").alias("volume")
    )
    return _finish(summed)


def vwap(
    trades: DataFrame,
    length: str = schemas.VWAP_LENGTH,
    slide: str = schemas.VWAP_SLIDE,
    delay: str = schemas.WATERMARK_DELAY,
    exact: bool | int = False,
    valid_only: bool = False,
    panes_first: bool = False,
) -> DataFrame:
    """VWAP and volume per symbol and sliding window: (window_end, symbol, vwap, total_volume).

    VWAP is NULL where the volume is zero. A trade without a price adds to the volume only,
    unless ``valid_only`` leaves it out; NaN and infinite numbers count as missing. Sums are
    doubles, whose last digits depend on the order of addition; ``exact`` sums decimals of 18
    digits instead, 8 of them places or as many as it says, and fails on a value that such a
    decimal does not hold, too large or with more places, rather than round it. A slide
    longer than the window is refused.

    Batch input is summed into panes first and the panes into windows, so the trades are
    not multiplied by length / slide. A stream keeps one aggregation, which serves every
    output mode, with ``delay`` as its watermark. With ``panes_first`` a stream, too, sums panes
    and then windows of the finished panes, each in a state of its own: for append mode only, and
    a trade that is late for its pane is then in none of its windows, where one aggregation
    would still add it to those that are open.
    """
    check_window(length, slide)
    if valid_only:
        trades = trades.filter(F.col("price").isNotNull() & F.col("quantity").isNotNull())
    if trades.isStreaming:
        on_time = trades.withWatermark("event_time", delay)
        if panes_first:
            return _chained(on_time, length, slide, exact)
        window = F.window("event_time", length, slide).alias("window")
        return _finish(on_time.groupBy(window, "symbol").agg(*_sums(exact)))
    pane = common_pane(length, slide)
    if pane == common_pane(length, length):
        window = F.window("event_time", length).alias("window")
        return _finish(trades.groupBy(window, "symbol").agg(*_sums(exact)))
    return vwap_from_panes(trade_panes(trades, pane, exact), length, slide)


def _chained(on_time: DataFrame, length: str, slide: str, exact: bool | int) -> DataFrame:
    """Windows of finished panes on a stream: the second aggregation takes a pane's event time."""
    pane = F.window("event_time", common_pane(length, slide)).alias("window")
    panes = on_time.groupBy(pane, "symbol").agg(*_sums(exact))
    dated = panes.select(F.window_time("window").alias("pane_time"), "symbol", "notional", "volume")
    window = F.window("pane_time", length, slide).alias("window")
    summed = dated.groupBy(window, "symbol").agg(
        F.sum("notional").alias("notional"), F.sum("volume").alias("volume")
    )
    return _finish(summed)


def volume(
    trades: DataFrame,
    length: str = schemas.VWAP_SLIDE,
    delay: str = schemas.WATERMARK_DELAY,
    exact: bool | int = False,
) -> DataFrame:
    """Traded volume per symbol and tumbling window."""
    metrics = vwap(trades, length, length, delay, exact)
    return metrics.select("window_end", "symbol", "total_volume")
